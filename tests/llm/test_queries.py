"""Every registered query of the operators on the smallest test set: the contract's columns and rows."""

import hashlib
import zlib

import pandas as pd
import pytest
from conftest import SF_DIR

import __spark_entry__ as registry
from claimstar.llm import bpe, fingerprints

COLUMNS = {
    "op1_toxicity": "doc_id held_out score predicted",
    "op2_simhash": "doc_id fingerprint component_id",
    "op3_quality": "doc_id held_out score predicted",
    "op4_secrets": "doc_id begin end secret",
    "op5_wavelet": "doc_id start n_tokens ids_crc32",
    "op6_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op7_html": "page_id url text n_chars",
    "op8_mixing": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op9_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op10_decontamination": "doc_id item_id distance",
    "op11_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "pipeline": "doc_id piece start length ids_crc32 sequence_id offset",
}
PER_DOCUMENT = ("op1", "op2", "op3", "op5", "op6", "op8", "op11", "op12")


def test_every_query_is_listed():
    assert set(COLUMNS) == {*registry.llm.queries(), "pipeline"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_keeps_the_contract(spark, name):
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet").sort_values("doc_id")
    found = registry.queries()[name](spark, SF_DIR).toPandas()
    assert set(COLUMNS[name].split()) <= set(found.columns)
    if name.split("_")[0] in PER_DOCUMENT:
        found = found.sort_values("doc_id", ignore_index=True)
        assert found["doc_id"].tolist() == docs["doc_id"].tolist()
    if "held_out" in found:
        modulus, remainder = {"op1": (4, 2), "op3": (5, 0), "op8": (5, 1)}[name[:3]]
        rests = [zlib.crc32(str(i).encode()) % modulus for i in found["doc_id"]]
        assert found["held_out"].tolist() == [r == remainder for r in rests]
    if "predicted" in found:
        assert found["score"].between(0, 1).all()
        assert (found["predicted"] == (found["score"] >= 0.3)).all()
    if name == "op5_wavelet":
        ids = list(bpe.encoder(bpe.vocabulary()).encode_many(docs["text"].tolist()))
        sizes = [len(x) for x in ids]
        assert found["n_tokens"].tolist() == sizes
        assert found["start"].tolist() == [sum(sizes[:n]) for n in range(len(sizes))]
        assert found["ids_crc32"].tolist() == [bpe.ids_crc32(x) for x in ids]
    if name == "op6_fingerprints":
        texts = docs["text"].fillna("").tolist()
        edits = [fingerprints.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1])]
        assert found["edited_sha256"].tolist() == [hashlib.sha256(t.encode()).hexdigest() for t in edits]
    if name == "op7_html":
        pages = pd.read_parquet(f"{SF_DIR}/pages.parquet")
        assert sorted(found["page_id"]) == sorted(pages["page_id"])
        assert found["n_chars"].tolist() == found["text"].map(len).tolist()
    if "offset" in found:
        ends = found.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
        before = ends["length"].cumsum() - found["length"]
        assert (before == found["offset"]).all() and ends["length"].sum().max() <= 2048
