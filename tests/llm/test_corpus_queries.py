"""The registered corpus queries on the smallest tables, and the stages of the pipeline on
rows with nulls, repeats and columns of clashing names."""

import os

import duckdb
import pytest

import corpus_pipeline
from gridmill.llm import decontamination, similarity
from gridmill.llm.registry import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op2_perplexity": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3_similarity": ["doc_id", "n_shingles", "component_id"],
    "op4_tokens": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_media": ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
    "op8_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op10_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op11_pieces": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op12_search": ["item_id", "rank", "doc_id", "score"],
    "op13_turns": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
}
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns[: len(COLUMNS[name])] == COLUMNS[name]
    got = [tuple(map(plain, r)) for r in df.select(COLUMNS[name]).collect()]
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    if COLUMNS[name][0] == "doc_id":
        assert len(got) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    if name in ORACLE_SQL:
        found = con.execute(f"SELECT {', '.join(COLUMNS[name])} FROM ({ORACLE_SQL[name]})").fetchall()
        assert sorted(got, key=str) == sorted((tuple(map(plain, r)) for r in found), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with nulls, repeated rows and columns that the stages might name themselves."""
    words = ["k%d" % i for i in range(90)]
    text = " ".join(words)
    rows = [(1, text), (1, text), (2, text + " more"), (3, None), (3, None), (None, "one two"), (4, ""), (5, " ".join(reversed(words))), (6, "You fool. " + " ".join(words[:40]))]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, _nth int, _copies int, _copy int, _of string, row int, doc int, component int, size int"
    return spark.createDataFrame([(i, t, None, "s" if k % 2 else None, len(t or ""), *[7] * 4, "x", *[7] * 4) for k, (i, t) in enumerate(rows)], kind)


@needs_tables
@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stage_keeps_columns(spark, odd, stage):
    out = stage[1](spark, odd, FOLDER)
    assert out.columns == odd.columns
    rows = [tuple(r) for r in out.collect()]
    assert {r[5:] for r in rows} == {(*[7] * 4, "x", *[7] * 4)}
    assert stage[1](spark, odd.limit(0), FOLDER).count() == 0


def test_one_of_each_group_stays(spark, odd):
    kept = similarity.keep_one_of_each(odd)
    want = sorted([("1", odd.first().text[:5]), ("3", None), ("3", None), ("4", ""), ("5", "k89 k"), ("6", "You f"), ("None", "one t")], key=str)
    assert sorted([(str(r.doc_id), r.text if r.text is None else r.text[:5]) for r in kept.collect()], key=str) == want


@needs_tables
def test_pipeline_runs_whole(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > sizes[0] / 2
    hit = decontamination.contamination(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    assert hit.where("n_hit > 0").count() == 0
    assert similarity.near_duplicates(docs).where("component IS NOT NULL").groupBy("component").count().where("count > 1").count() <= 2  # cuts can make documents alike
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0

