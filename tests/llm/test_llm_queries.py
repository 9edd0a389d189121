"""The registered queries on the smallest tables: contracts, and the pipeline by brute force."""

import base64
import hashlib
import zlib

import public_tokenizers
import pytest
from test_decontamination import brute_force as leaks_of
from test_licenses import brute_force as licenses_of
from test_simhash import plain_fingerprint, union
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from ledgerloom.llm.queries import QUERIES

COLUMNS = {
    "op1_toxicity": "doc_id long, held_out boolean, score double, predicted int",
    "op2_warc": "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    "op3_quality": "doc_id long, held_out boolean, score double, predicted int",
    "op4_bpe": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    "op5_decontamination": "doc_id long, item_id long, containment double",
    "op6_licenses": "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    "op7_exact_dedup": "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string",
    "op8_chat": "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    "op9_sharding": "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int",
    "op10_simhash": "doc_id long, fingerprint string, component_id long",
    "op11_whitening": "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double",
    "op12_packing": "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    "op13_periodicity": "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string",
}


@pytest.fixture(scope="module")
def results(llm):
    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = __spark_entry__.queries()[name](llm, "/root/testdata/sf0.001").toPandas()
        return kept[name]

    return run


@pytest.fixture(scope="module")
def tables(llm):
    return lambda name: llm.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").collect()


def test_every_query_and_the_pipeline():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(llm, name):
    frame = __spark_entry__.queries()[name](llm, "/root/testdata/sf0.001")
    kinds = {f.name: f.dataType for f in frame.schema}
    wanted = llm.createDataFrame([], COLUMNS[name]).schema
    assert {f.name: kinds.get(f.name) for f in wanted} == {f.name: f.dataType for f in wanted}


@pytest.mark.parametrize("name, threshold", [("op1_toxicity", 0.3), ("op3_quality", 0.7)])
def test_scores(results, tables, name, threshold):
    found = results(name)
    assert sorted(found["doc_id"]) == sorted(r["doc_id"] for r in tables("documents"))
    assert found["score"].between(0, 1).all()
    assert (found["predicted"] == (found["score"] >= threshold)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(found["doc_id"], found["held_out"]))


def test_warc(results, tables):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in tables("pages")}
    first = {}
    for page_id in sorted(pages):
        first.setdefault(pages[page_id], page_id)
    found = results("op2_warc").set_index("page_id")
    assert len(found) == len(pages)
    for page_id, data in pages.items():
        row = found.loc[page_id]
        assert row["payload_bytes"] == len(data)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        if first[data] == page_id:
            assert row["record_type"] == "response" and row["refers_to"] != row["refers_to"]
        else:
            assert row["record_type"] == "revisit" and row["refers_to"] == first[data]


def test_licenses(results, tables):
    found = results("op6_licenses").set_index("doc_id")
    for r in tables("documents"):
        n, base, more = licenses_of(r["text"])
        row, places = found.loc[r["doc_id"]], [b["word"] for b in base]
        assert (row["n_words"], row["n_base"]) == (n, len(base))
        if places:
            assert (row["first_word"], row["last_word"]) == (min(places), max(places))
        assert row["base_labels"] == ",".join(sorted({b["label"] for b in base}))
        assert row["labels"] == ",".join(sorted({b["label"] for b in base + more}))
        assert row["score"] == (1.0 if base else max([m["containment"] for m in more], default=0.0))


def test_sharding(results):
    found = results("op9_sharding")
    loads = found.groupby("shard")["size"].sum()
    assert set(found["law"]) == {"bytes"} and set(found["shard"]) == set(range(40)) and found["grown_shard"].isna().all()
    assert loads.max() - loads.min() <= found["size"].max()
    for _, part in found.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_simhash(results, tables):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in tables("documents")]
    roots = union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 3])
    low = {}
    for (i, _), r in zip(rows, roots):
        low[r] = min(low.get(r, i), i)
    expected = {i: (f"{f:016x}", low[r]) for (i, f), r in zip(rows, roots)}
    found = results("op10_simhash")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found.itertuples()} == expected


def test_pipeline_by_brute_force(llm, results, tables):
    docs = {r["doc_id"]: r["text"] or "" for r in tables("documents")}
    good = results("op3_quality")
    docs = {i: docs[i] for i in good[good["predicted"] == 1]["doc_id"]}
    last = {text: i for i, text in sorted(docs.items())}
    ids = sorted(last.values())
    fps = [plain_fingerprint(docs[i]) for i in ids]
    roots = union(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    ids = [i for k, i in enumerate(ids) if roots[k] == k]
    items = [(r["item_id"], r["text"]) for r in tables("benchmark")]
    leaking = {d for d, *_ in leaks_of([(i, docs[i]) for i in ids], items)}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {
        i: (len(e), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in e)).hexdigest())
        for i in ids
        if i not in leaking
        for e in [library.encode(docs[i], add_special_tokens=False).ids]
    }
    found = results("pipeline")
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in found.itertuples()} == expected
    assert leaking and len(expected) < len(ids)


def test_stages_keep_the_columns_of_documents(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(llm, docs, sf_dir)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        assert stage(llm, docs.limit(0), sf_dir).count() == 0
