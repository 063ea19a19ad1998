"""The pipeline, stage by stage, against plain Python over small tables with odd rows."""

import math
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from claimstar.llm import bpe, common, secrets, toxicity

from .test_operators import ODD, plain_print, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, score string"
KEY = "token = \"%s\""


def table_rows():
    """Texts of documents by id; then benchmark items. Ids 0 to 899 carry labels."""
    texts = {}
    for i, t in enumerate(prose(21, 900)):
        texts[i] = t + (" you total nasty moron here." if i % 4 == 1 else "") + " The end."
    items = [(i, t) for i, t in enumerate(prose(22, 12)) if len(t.split()) > 15]
    filler = prose(23, 40)
    for k, (i, t) in enumerate(items):
        words = t.split()
        words[3] = "zzz"
        texts[1000 + k] = f"{filler[k]} {' '.join(words) if k % 2 else t} {filler[k + 1]}"
    for k in range(5):
        texts[1100 + k] = f"{filler[20 + k]} {KEY % (f'{k}b9f04e2a7' * 4)} {filler[30 + k]}"
    long = " ".join(prose(24, 400))
    texts |= {1200 + i: t for i, t in enumerate([*ODD, texts[2], texts[1100], long, long])}
    return texts, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    texts, items = table_rows()
    at = tmp_path_factory.mktemp("tables")
    rows = [(i, t, None, "hot", len(t or ""), "x", "y") for i, t in texts.items()]
    rows += [(None, "no id", None, None, None, None, None), (6, texts[6], "twice", None, 3, None, None)]
    labels = [(i, 1, int(i % 4 == 1), "z") for i in range(900)] + [(None, 1, 1, None), (5, None, None, None)]
    tables = {
        "documents": spark.createDataFrame(rows, COLUMNS),
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"),
        "benchmark": spark.createDataFrame([*items, (99, None), (None, "x y z")], "item_id long, text string"),
    }
    for name, frame in tables.items():
        frame.write.parquet(f"{at}/{name}.parquet")
    return str(at)


def plain_toxicity(model, text):
    total = 0.0
    sentences = re.split(r"[.?\n]+|(?<!!)!(?!!)", (text or "").lower())
    bags = [w for w in (re.findall(r"[^\W\d_]+", s) for s in sentences) if w] or [[]]
    for bag in bags:
        z = model.bias + sum(model.weights.get(f, 0.0) for w in bag for f in toxicity.features(w))
        total += math.log1p(math.exp(z))
    return 1 - math.exp(-total)


def least_of_groups(texts):
    """The least id of each group of fingerprints linked at three bits."""
    ids = sorted(texts)
    prints = {i: plain_print(texts[i]) for i in ids}
    kept, left = set(), set(ids)
    for i in ids:
        if i in left:
            kept.add(i)
            queue = [i]
            left.discard(i)
            while queue:
                one = prints[queue.pop()]
                near = [j for j in left if (prints[j] ^ one).bit_count() <= 3]
                left.difference_update(near)
                queue += near
    return kept


def holds(text, item):
    """The item within a fifth of its words in edits of some passage."""
    words = lambda t: re.sub(rb"[^0-9a-z\x80-\xff]", b" ", (t or "").lower().encode()).split()
    doc, want = words(text), words(item)
    row = [0] * (len(doc) + 1)
    for i, w in enumerate(want, 1):
        new = [i]
        for j, x in enumerate(doc, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[j - 1] + 1))
        row = new
    return bool(want) and min(row) <= math.floor(0.2 * len(want) + 1e-9)


def test_stages_against_brute_force(spark, folder):
    texts, items = table_rows()
    docs = common.table(spark, folder, "documents")
    model = toxicity.learn(docs, common.table(spark, folder, "labels"))
    want = {i: t for i, t in texts.items() if plain_toxicity(model, t) < toxicity.THRESHOLD}
    assert len(texts) - 240 <= len(want) <= len(texts) - 200
    kept = least_of_groups(want)
    clean = {i: t for i, t in want.items() if i in kept and not any(holds(t, x) for _, x in items)}
    assert not {i for i in clean if 1000 <= i < 1100} and {i for i in clean if 1100 <= i < 1105}
    masked = {
        i: re.sub("[0-9a-f]{30,}", secrets.MASK, t or "") if 1100 <= i < 1105 else t for i, t in clean.items()
    }
    expected = [want, {i: want[i] for i in kept}, clean, masked]

    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        before = docs.columns
        docs = common.stored(stage(spark, docs, folder), f"test-{n}")
        assert docs.columns == before
        rows = docs.select("doc_id", "text", "n_chars").collect()
        named = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
        assert named == expected[n], name
        assert len(rows) == len(named) + 1 + (n == 0)  # the row without an id; id 6 twice at first
    assert all(r["n_chars"] == len(r["text"]) for r in rows if 1100 <= (r["doc_id"] or 0) < 1105)

    encoder = bpe.encoder(bpe.vocabulary())
    pieces, filled = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    masked[None] = "no id"
    assert set(pieces) == set(masked)
    for (i, found), ids in zip(pieces.items(), encoder.encode_many([masked[i] for i in pieces])):
        at = 0
        for n, (piece, start, length, crc) in enumerate(sorted(found)):
            assert (piece, start, crc) == (n, at, bpe.ids_crc32(ids[at : at + length]))
            at += length
        assert at == len(ids)
    for parts in filled.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    total = sum(n for parts in filled.values() for _, n in parts)
    assert len(filled) <= 1.02 * total / 2048 + 1


def test_empty_tables_go_through(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        common.table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
