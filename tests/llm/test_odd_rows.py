"""Text ids, nulls and long texts through every query over documents, and the base forms of
personal data in time that grows with the text alone."""

import random
import time

import pyarrow as pa
import pytest

from gridmill.llm import media, pii
from gridmill.llm.registry import QUERIES

ROWS = [("id1", "password=abcdef1 a@b.cd " * 3, "x"), ("id2", None, None), (None, "", "x"), ("id2", None, None), ("é", " ".join(f"w{i % 40}" for i in range(400)), "y"), ("id3", "7" * 30_000 + "@" + "k" * 30_000, "y")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, 2) for i, t, s in ROWS], "doc_id string, text string, lang string, source string, n_chars long, row int, component int").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([("b1", " ".join(f"w{i}" for i in range(15))), (None, None)], "item_id string, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([("id1", 1), ("é", 0), (None, None)], "doc_id string, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n not in ("op12_search", "op13_turns")])
def test_a_row_for_each_row(spark, folder, name):
    got = QUERIES[name](spark, folder)
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    assert sorted(str(r.doc_id) for r in got.select("doc_id").collect()) == sorted(str(i) for i, _, _ in ROWS)


def test_search_with_text_ids(spark, folder):
    got = QUERIES["op12_search"](spark, folder).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in got] == [("b1", 1, "é")]


def test_base_forms_are_what_the_patterns_find():
    random.seed(2)
    for _ in range(20_000):
        text = "".join(random.choice("aZ9.-@@ 1_%é:+ ") for _ in range(random.randint(0, 40)))
        assert pii._emails(text) == [m.span() for m in pii._EMAIL.finditer(text)], text
        text = "".join(random.choice("12.. a") for _ in range(random.randint(0, 30)))
        assert [m.span() for m in pii._IP_RUNS.finditer(text)] == [m.span() for m in pii._IP.finditer(text)], text


@pytest.mark.parametrize("unit", ["7", "a", "a@", "1.", "a.", "-", "+1", "1-", "1.2.3.4,"])
def test_a_megabyte_takes_about_a_second(unit):
    text = unit * (1_000_000 // len(unit)) + "@"
    began = time.time()
    pii.base_spans(text)
    assert time.time() - began < 3


def test_archives_keep_ids_of_both_kinds(spark, tmp_path):
    for kind, ids in (("long", [1, None, -5]), ("string", ["a", None, "é"])):
        media.write_archives(spark.createDataFrame([(i, "t") for i in ids], f"doc_id {kind}, text string"), f"{tmp_path}/{kind}")
        back = spark.read.format("media_archive").option("path", f"{tmp_path}/{kind}").load()
        assert back.schema["doc_id"].dataType.typeName() == kind
        assert sorted(map(str, (r.doc_id for r in back.collect()))) == sorted(map(str, ids))
    assert media.read_member(pa.BufferReader(media._HEAD.pack(b"MEMB", 2, 2, 1, 0, __import__("zlib").crc32(b"id")) + b"id"), 0)[0] == "id"
