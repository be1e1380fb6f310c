from pyspark.sql import functions as F

from tagloom.functions.arrays import strip_prompt_ids
from tagloom.operators.encode import encode_fixed, mask_labels, pad_batches


def test_mask_labels_cases(spark):
    df = spark.createDataFrame([([5, 6, 7], [9]), ([1, 2, 3, 4, 5, 6], [7])], "p array<int>, r array<int>")
    rows = mask_labels(df, "p", "r", 0, 6).collect()
    assert rows[0].input_ids == [5, 6, 7, 9, 0]
    assert rows[0].attention_mask == [1, 1, 1, 1, 1]
    assert rows[0].labels == [-100, -100, -100, 9, 0]
    assert rows[1].labels == [-100] * 6 and rows[1].n_target == 0


def test_pad_batches(spark):
    df = spark.createDataFrame(
        [(0, [1, 2, 3, 4, 5], [1] * 5, [-100, 2, 3, 4, 5]), (0, [1, 2, 3, 4], [1] * 4, [-100, 2, 3, 4])],
        "batch_id int, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )
    rows = sorted(pad_batches(df, "batch_id").collect(), key=lambda r: r.input_ids[-1])
    assert rows[0].input_ids == [1, 2, 3, 4, 0]
    assert rows[0].attention_mask == [1, 1, 1, 1, 0]
    assert rows[0].labels == [-100, 2, 3, 4, -100]


def test_strip_prompt_and_fixed(spark):
    df = spark.createDataFrame([([1, 2], [1, 2, 3, 4]), ([1, 2, 3], [1])], "i array<int>, o array<int>")
    assert [r.s for r in df.select(strip_prompt_ids("i", "o").alias("s")).collect()] == [[3, 4], []]
    e = encode_fixed(spark.createDataFrame([([7, 8, 9, 10],)], "ids array<int>"), "ids", 5).first()
    assert e.input_ids == [2, 7, 8, 9, 3] and e.attention_mask == [1] * 5 and e.token_type_ids == [0] * 5
    e = encode_fixed(spark.createDataFrame([([7],)], "ids array<int>"), "ids", 5).first()
    assert e.input_ids == [2, 7, 3, 0, 0] and e.attention_mask == [1, 1, 1, 0, 0]


def test_token_round_trip_with_nulls_and_unknowns(spark):
    from tagloom.operators.encode import UNK_ID, decode_ids, encode_tokens, token_vocab, tokenize

    docs = spark.createDataFrame([(1, "Hello, hello 世界!"), (2, None), (3, "zz unseen")], "id int, text string")
    toks = docs.select("id", tokenize("text").alias("tokens"))
    vocab = token_vocab(toks.where("id != 3"), "tokens", 100)
    enc = encode_tokens(toks, "tokens", vocab, 100)
    dec = {r.id: (r.input_ids, r.tokens) for r in decode_ids(enc, "input_ids", vocab, 100).collect()}
    assert dec[2] == (None, None)
    assert dec[1][1] == ["hello", ",", "hello", "世", "界", "!"]
    # tokens outside the vocabulary are spelled after an [UNK]
    assert dec[3][0].count(UNK_ID) == 2 and dec[3][1] == ["zz", "unseen"]
