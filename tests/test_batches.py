"""What a Python worker and the JVM hold of token ids depends on neither the rows of a batch nor their length."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.operators import encode as EN
from tagloom.operators import score as SC
from tagloom.session import BATCH_ROWS

ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def plain_batches(spark):
    spark.conf.unset(ROWS_CONF)
    yield
    spark.conf.unset(ROWS_CONF)


def test_parts_cover_everything_in_bounded_slices():
    arr = pa.array(["ab", None, "c" * 9, "", "de", "f"])
    got = [p.to_pylist() for p in SC.parts(arr, pa.array([2, None, 9, 0, 2, 1]), 4)]
    assert got == [["ab", None], ["c" * 9], ["", "de", "f"]]
    assert [len(p) for p in SC.parts(arr[:0], pa.array([], pa.int32()), 4)] == [0]
    assert SC.id_lists([[1, 2], None, []]).to_pylist() == [[1, 2], None, []]


def test_tokenizer_batches_are_small_and_nothing_is_lost(spark, plain_batches):
    df = spark.range(3 * BATCH_ROWS, numPartitions=1).select(
        "id", F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.repeat(F.lit("é字😀a"), (F.col("id") % 5).cast("int"))).alias("t"))
    ids = SC.tokenizer_udf(SC.codepoint_tokenizer)("t")
    assert int(spark.conf.get(ROWS_CONF)) <= BATCH_ROWS
    rows = df.select("id", "t", ids.alias("ids")).collect()
    assert len(rows) == 3 * BATCH_ROWS and all(r.ids == (None if r.t is None else [ord(c) for c in r.t]) for r in rows)


def test_tokenizer_returns_ids_in_parts(spark, plain_batches, monkeypatch):
    """A caller's tokenizer sees all texts; no array that goes back holds more than a part's texts."""
    fn = SC.tokenizer_udf(lambda: lambda t: [len(t)] * 3)
    monkeypatch.setattr(SC, "PART_BYTES", 100)
    out = list(fn.func(iter([pa.array(["x" * 60, "y" * 60, None, "z" * 500, "w"])])))
    assert [len(a) for a in out] == [1, 2, 1, 1]
    assert pa.concat_arrays(out).to_pylist() == [[60] * 3, [60] * 3, None, [500] * 3, [1] * 3]


def test_encoder_and_decoder_work_in_parts(spark, plain_batches, monkeypatch):
    docs = spark.range(2 * BATCH_ROWS, numPartitions=1).select(
        "id", F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.array(F.lit("a"), F.lit("bé"), F.concat(F.lit("x"), F.col("id").cast("string")))).alias("tokens"))
    vocab = spark.createDataFrame([("a", 4, 9), ("bé", 5, 8)], "token string, id int, n long")
    enc = EN.encode_tokens(docs, "tokens", vocab, 10)
    assert int(spark.conf.get(ROWS_CONF)) <= BATCH_ROWS
    rows = EN.decode_ids(enc, "input_ids", vocab, 10, "again").collect()
    assert len(rows) == 2 * BATCH_ROWS and all(r.tokens == r.again for r in rows)
    assert next(r for r in rows if r.id == 5).input_ids == [4, 5, 1, ord("x") + EN.SPELL_BASE, ord("5") + EN.SPELL_BASE]


def test_sizes_of_lists():
    lists = pa.array([["ab", "c"], None, [], ["def", None]])
    assert EN._list_bytes(lists).to_pylist() == [19, 0, 0, 19]
    assert EN._list_bytes(lists.slice(2)).to_pylist() == [0, 19]
    assert EN._list_bytes(pa.array([[1, 2], [3]], pa.list_(pa.int32()))).to_pylist() == [16, 8]
