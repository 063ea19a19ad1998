"""Operators against brute force, round trips and held-out labels, with the odd cases of texts."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from claimstar.llm import bpe, common, decontamination, fingerprints, html, mixing
from claimstar.llm import packing, quality, secrets, simhash, toxicity, wavelet

ODD = [None, "", " ", "\n", "a", "a  b\n\nc.", "x\t y <|endoftext|> z", "½ ², é×.", "a\x01b"]


def documents(spark, rows):
    """Documents with a clashing extra column."""
    rows = [(i, t, "label", "score") for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, label string, score string")


def prose(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choices(["th", "er", "on", "an", "re", "ti"], k=r.randint(1, 4))) for _ in range(300)]
    return [" ".join(r.choices(words, k=r.randint(3, 120))) + "." for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    texts = prose(1, 60)
    texts += [texts[3], texts[3], texts[5] + " extra", "long " * 5000]
    return [(i, t) for i, t in enumerate([*ODD, *texts])] + [(3, "twice"), (None, "no id")]


def test_encoder_equals_the_library(corpus):
    encoder = bpe.Encoder(bpe.vocabulary(), cached=50)
    texts = [t for _, t in corpus]
    for text, ids in zip(texts, encoder.encode_many(texts)):
        whole = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == [*whole, bpe.END]


def test_wavelet_matrix_against_lists():
    r = np.random.default_rng(0)
    for n in (0, 1, 511, 513, 5000):
        ids = r.integers(0, 700, n).astype(np.uint32)
        w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
        assert w.decode().tolist() == ids.tolist()
        for token in (0, 5, 699, 5000):
            assert w.occurrences(token).tolist() == np.flatnonzero(ids == token).tolist()
            assert w.count(token) == (ids == token).sum()
            assert w.rank(token, n // 2) == (ids[: n // 2] == token).sum()
        assert all(w.access(i) == ids[i] for i in range(0, n, 97))


def test_shards_round_trip(spark, corpus, tmp_path):
    wavelet.write(documents(spark, corpus), f"{tmp_path}/s", bpe.vocabulary(), 3, block=500)
    found = wavelet.documents(wavelet.read(spark, f"{tmp_path}/s")).collect()
    encoder = bpe.encoder(bpe.vocabulary())
    at = 0
    for row in sorted(found, key=lambda r: r["start"]):
        assert row["start"] == at
        at += row["n_tokens"]
    want = Counter((i, len(x), bpe.ids_crc32(x)) for (i, _), x in zip(corpus, encoder.encode_many([t for _, t in corpus])))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want


def test_packing_is_gapless_and_tight(spark, corpus):
    rows = packing.pack(documents(spark, corpus), bpe.vocabulary(), 64).collect()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in rows)
    assert len(by) <= 1.05 * total / 64 + 2


def test_sweeps_never_overlap():
    r = random.Random(2)
    lengths = {r.randint(1, 50): r.randint(1, 40) for _ in range(30)}
    plan = packing.sweeps(lengths, 50)
    used = Counter()
    for length, n in lengths.items():
        rows = [p for p in plan if p[0] == length]
        for rank in range(n):
            p = [x for x in rows if x[1] <= rank][-1]
            k = rank - p[1]
            for i in range(length):
                used[(p[2] + k // p[3], p[4] + k % p[3] * length + i)] += 1
    assert set(used.values()) == {1} and max(o for _, o in used) < 50


def test_golay_keys_find_all_links():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << r.integers(0, 64, len(a)).astype(np.uint64)
    asked = set(zip(*(x.tolist() for x in simhash.keys(a, True))))
    filed = zip(*(x.tolist() for x in simhash.keys(b, False)))
    assert {row for row, key in filed if (row, key) in asked} == set(range(len(a)))


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_against_brute_force(spark, corpus):
    rows = [(i, t) for i, t in corpus if i is not None and t != "twice"]
    prints = {i: plain_print(t) for i, t in rows}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(prints, 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 3:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    docs = documents(spark, rows)
    groups = simhash.near_duplicates(docs)
    found = {r["doc_id"]: (r["print"] % (1 << 64), r["component_id"]) for r in groups.collect()}
    assert found == {i: (p, find(i)) for i, p in prints.items()}
    kept = simhash.representatives(docs, groups)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({find(i) for i in prints})


def test_leaks_exact_and_edited(spark):
    r = random.Random(4)
    items = [(i, t) for i, t in enumerate(prose(9, 30)) if len(t.split()) > 12]
    filler = prose(10, 40)
    docs, expected = [], set()
    for k, (i, t) in enumerate(items):
        words = t.split()
        for _ in range(len(words) // 12):
            words[r.randrange(len(words))] = "zzz"
        docs.append((k, filler[k % 40] + " " + " ".join(words) + " " + filler[(k + 1) % 40]))
        expected.add((k, i))
    docs += [(1000 + k, f) for k, f in enumerate(filler)] + [(None, None), (2000, "")]
    bench = spark.createDataFrame([*items, (999, None), (998, "")], "item_id long, text string")
    frame = documents(spark, docs)
    found = decontamination.leaks(frame, bench, block=7)
    pairs = {(x["doc_id"], x["item_id"]) for x in found.collect()}
    assert len(expected & pairs) >= 0.95 * len(expected)
    assert not {d for d, _ in pairs if d >= 1000}
    assert decontamination.without_leaks(frame, found).where("doc_id >= 1000").count() == 41


def test_toxicity_learns_words_and_finds_sentences():
    r = random.Random(5)
    texts, labels = [], []
    for t in prose(6, 600):
        toxic = r.random() < 0.3
        texts.append(t + (" you total nasty moron here." if toxic else "") + " The end.")
        labels.append(int(toxic))
    model = toxicity.fit(texts[:400], labels[:400])
    right = sum((model.score(t) >= 0.3) == y for t, y in zip(texts[400:], labels[400:]))
    assert right >= 190
    text = "All is well. You total nasty moron here. Fine."
    assert [text[a:b].strip(". ") for a, b, _ in model.spans(text)] == ["You total nasty moron here"]
    assert all(0 <= model.score(t) <= 1 for t in ODD)
    assert toxicity.fit([], []).score("x") < 0.01


def test_quality_learns_junk():
    good, bad = prose(7, 300), [t.upper().replace(" ", "!! ") for t in prose(8, 300)]
    x = np.array([quality.statistics(t) for t in good + bad])
    y = np.array([1.0] * 300 + [0.0] * 300)
    half = np.arange(600) % 2 == 0
    model = quality.fit(x[half], y[half])
    assert ((model.scores(x[~half]) >= 0.3) == y[~half]).mean() > 0.97
    assert np.isfinite(model.scores(np.array([quality.statistics(t) for t in ODD]))).all()
    assert quality.fit(x[:0], y[:0]).scores(x[:2]).tolist() == [0.5, 0.5]


PAGE = (
    '<html lang=en><head><title>t</title><script>var a="</p>"</script></head><body><nav><a href=x>Home</a></nav>'
    "<article><h1>Head &amp; line</h1><p>First <b>bo</b>ld\n  text<br>on.<p>Second.</article>"
    "<div class='comments'><p>Nice post and I like it.</div><footer>&copy; us</footer></body>"
)


def test_main_text():
    assert html.extract(PAGE) == "Head & line\n\nFirst bold text on.\n\nSecond."
    assert html.extract(PAGE[: PAGE.index("Second") + 3]).endswith("Sec")
    assert [html.extract(t) for t in (None, "", "<", "<p", "<!--")] == [""] * 5


def test_fingerprints_follow_edits(spark, corpus):
    rows = [(i, t) for i, t in corpus if i is not None and t != "twice"]
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(documents(spark, rows)).collect()}
    texts = [t or "" for _, t in sorted(rows)]
    assert len(found) == len(rows)
    for i, (a, b) in enumerate(zip(texts, texts[1:] + texts[:1])):
        row = found[i]
        changed = fingerprints.edited(a, b)
        own, other = fingerprints.embed([a]), fingerprints.embed([changed])
        assert row["n_chars"] == len(a)
        assert row["fingerprint"] == fingerprints.as_text(own[0])
        assert row["edited_fingerprint"] == fingerprints.as_text(other[0])
    long = [found[i] for i, t in rows if t and len(t) > 200]
    assert np.mean([r["near_edited"] for r in long]) > 0.6 > 0.2 > np.mean([r["near_next"] for r in long[:-6]])


def test_secrets_are_found_and_masked(spark):
    r = random.Random(8)
    hexes = ["".join(r.choices("0123456789abcdef", k=40)) for _ in range(30)]
    rows = [(i, f'say token = "{h}" and go antidisestablishmentarianism') for i, h in enumerate(hexes)]
    rows += [(100 + i, t + " internationalizationings 4785380592391139") for i, t in enumerate(prose(11, 30))]
    rows += [(200 + i, t) for i, t in enumerate(ODD)]
    docs = documents(spark, rows)
    found = secrets.scan(docs)
    assert {(x["doc_id"], x["secret"]) for x in found.collect()} == set(enumerate(hexes))
    texts = dict(rows)
    assert all(texts[x["doc_id"]][x["begin"] : x["end"]] == x["secret"] for x in found.collect())
    masked = {x["doc_id"]: x["text"] for x in secrets.redacted(docs, found).collect()}
    assert masked == {i: t.replace(hexes[i], secrets.MASK) if i < 30 else t for i, t in rows}


def test_mixing_base_and_gain(spark, corpus):
    rows = [(i, t) for i, t in corpus if i is not None and t != "twice"]
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for i, t in rows}
    learnt = [w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws]
    c, n = Counter(learnt), len(learnt)
    for r in mixing.scores(documents(spark, rows), 5, 1).collect():
        ws = tokens[r["doc_id"]]
        base = sum(np.log10((c[w] + 0.5) / (n + 0.5 * (len(c) + 1))) for w in ws)
        assert r["base_score"] == pytest.approx(base)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["score"] < 0


def test_mixing_does_not_depend_on_splits(spark, corpus):
    """Parts are stored with the rows: scans that are split otherwise later find the same words."""
    rows = [(i, t) for i, t in corpus if i is not None]
    docs = documents(spark, rows).repartition(3)
    whole = {str(r) for r in mixing.scores(docs, 5, 1).select("doc_id", "n_tokens", "n_known", "base_score").collect()}
    found = mixing.scores(docs, 5, 1, part_bytes=500)
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "23")
    try:
        later = {str(r) for r in found.select("doc_id", "n_tokens", "n_known", "base_score").collect()}
    finally:
        if before is None:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        else:
            spark.conf.set("spark.sql.files.minPartitionNum", before)
    assert later == whole


def test_words_of_parts_are_counted_apart():
    """Each stretch of a part has all of its words; a part's rows of two stretches add up."""
    texts = ["a b a", None, "b c", "a", "b b"]
    parts, learn = [7, 7, 9, 9, 7], [True, False, False, True, True]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int64()), pa.array(range(5), pa.int64()), pa.array(learn), pa.array(texts)],
        ["part", "doc_id", "learn", "text"],
    )
    found = Counter()
    for b in mixing._count_words(iter([batch.slice(0, 3), batch.slice(3)])):
        for r in b.to_pylist():
            found[r["part"], r["key"]] += r["n"]
    t = mixing.tokens(["a b c"])
    a, b, c, end = (int(k) for k in t.key)
    assert found == {(7, a): 2, (7, b): 3, (7, end): 2, (9, a): 1, (9, b): 0, (9, c): 0, (9, end): 1}


def test_mixing_scores_as_a_plain_loop_does():
    """The vectorised score of a text against one written token by token and bit by bit."""
    random = np.random.default_rng(3)
    model = mixing.Model(
        logit=random.normal(0, 1, mixing.SLOTS),
        level=random.integers(0, 3, mixing._WIDTH[3]),
        weight=random.normal(0.25, 0.1, (mixing.GATES, mixing.PREDICTORS)),
        refined=random.uniform(0.1, 0.9, (256, mixing.BUCKETS)),
        repeat=random.uniform(0.05, 0.5, mixing.REPEATS),
        class_tokens=np.ones(256),
        class_words=np.ones(256),
        n_tokens=256,
    )
    texts = ["the cat sat on the mat the cat", "", "word", " ".join(prose(5, 3))]
    t = mixing.tokens(texts)
    static = model.class_logprob(t)
    mixed = model.mixed(static, t)
    at = 0
    for text in texts:
        words = text.split() + [None]
        two = one = mixing.START
        seen, again, last = Counter(), 0, 0
        for place, word in enumerate(words):
            cls, p_class = int(t.cls[at]), 1.0
            for b in range(7, -1, -1):
                node, bit = 1 << (7 - b) | cls >> (b + 1), cls >> b & 1
                slots = (
                    node,
                    mixing._OFFSET[1] + one * 256 + node,
                    mixing._OFFSET[2] + two * 256 + node,
                    mixing._OFFSET[3] + (one * mixing.GROUPS + two * 7 % mixing.GROUPS) * 256 + node,
                )
                gate = node * 3 + model.level[slots[3] - mixing._OFFSET[3]]
                z = sum(model.weight[gate, i] * model.logit[s] for i, s in enumerate(slots))
                cell = min(max(int((z + 6) * mixing.BUCKETS / 12), 0), mixing.BUCKETS - 1)
                p = 0.5 / (1 + np.exp(-z)) + 0.5 * model.refined[node, cell]
                p_class *= p if bit else 1 - p
            assert static[at] == pytest.approx(np.log(p_class))
            context = min(int(np.log2(place + 1)), 7) * 32 + min(int(again / max(place, 1) * 16), 15) * 2 + last
            share = model.repeat[context] if place else 0.0
            expected = (1 - share) * p_class + share * seen[word] / max(place, 1)
            assert mixed[at] == pytest.approx(np.log(expected))
            last = int(seen[word] > 0)
            again += last
            seen[word] += 1
            one, two = cls, one
            at += 1
    assert at == len(t.cls)


def test_empty_tables(spark):
    docs = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert toxicity.score(docs, toxicity.learn(docs, labels)).isEmpty()
    assert quality.score(docs, quality.learn(docs, labels)).isEmpty()
    assert simhash.near_duplicates(docs).isEmpty()
    assert decontamination.leaks(docs, bench).isEmpty()
    assert secrets.scan(docs).isEmpty()
    assert packing.pack(docs, bpe.vocabulary()).isEmpty()
    assert fingerprints.fingerprints(docs).isEmpty()
    assert mixing.scores(docs, 5, 1).isEmpty()
    assert common.shared_dir(spark)


def every_row(operator, spark, docs):
    """The ids of the operator's result, one per document."""
    if operator == "toxicity":
        return toxicity.score(docs, toxicity.fit(["you moron.", "all well."] * 9, [1, 0] * 9))
    if operator == "quality":
        x = np.array([quality.statistics(t) for t in prose(3, 20)])
        return quality.score(docs, quality.fit(x, np.arange(20) % 2 * 1.0))
    if operator == "simhash":
        return simhash.near_duplicates(docs)
    if operator == "fingerprints":
        return fingerprints.fingerprints(docs)
    if operator == "mixing":
        return mixing.scores(docs, 5, 1)
    if operator == "packing":
        return packing.pack(docs, bpe.vocabulary(), 64).where("piece = 0")
    pages = docs.selectExpr("doc_id as page_id", "concat('u', doc_id) as url", "text as html", "label as text")
    return html.main_text(pages).withColumnRenamed("page_id", "doc_id")


@pytest.mark.parametrize(
    "operator", ["toxicity", "quality", "simhash", "fingerprints", "mixing", "packing", "html"]
)
def test_odd_and_repeated_rows_all_stay(spark, corpus, operator):
    found = every_row(operator, spark, documents(spark, corpus))
    assert Counter(r["doc_id"] for r in found.collect()) == Counter(i for i, _ in corpus)


def test_scores_do_not_depend_on_other_columns(spark, corpus):
    model = toxicity.fit(["you moron.", "all well."] * 9, [1, 0] * 9)
    plain = documents(spark, corpus)
    moved = plain.selectExpr("'other' as label", "text", "-1 as score", "doc_id")
    first, second = (Counter(map(str, toxicity.score(d, model).collect())) for d in (plain, moved))
    assert first == second
    lone = toxicity.score(plain, model).where("doc_id is null").first()
    assert lone["score"] == pytest.approx(model.score("no id"))


def test_secrets_of_repeated_and_nameless_rows(spark):
    key = "0f3a9c71e5b28d46" * 3
    rows = [(1, f'token = "{key}"'), (1, f'token = "{key}"'), (None, f'token = "{key}"'), (2, None)]
    found = secrets.scan(documents(spark, rows))
    assert Counter(r["doc_id"] for r in found.collect()) == {1: 2, None: 1}
    texts = [r["text"] for r in secrets.redacted(documents(spark, rows), found).collect()]
    masked = f'token = "{secrets.MASK}"'
    assert Counter(texts) == {masked: 2, rows[2][1]: 1, None: 1}


def test_main_text_of_a_long_page():
    paragraphs = [f"This is the paragraph of number {i} and it is in the article." for i in range(20000)]
    page = "<body><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article></body>"
    assert html.extract(page) == "\n\n".join(paragraphs)
