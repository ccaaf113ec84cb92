import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from bookpipe.llm.packing import pack
from bookpipe.llm.queries import QUERIES, tokenizer

ODD = ["", None, "Plain words, plain ends.", "don't you've I'll it's", "<|endoftext|>x <|ENDOFTEXT|>", "Straße ÉCOLE École naïve",
       "ΑΣ Σας İstanbul ǅ", "a b c​d\x1ce", "日本語 テスト 🙂🙂", "123 4.56,7", "x" * 5000, "...", "a.b.c!!! --- $$$",
       "tab\tline\nfeed\x0bform\x0c", "́ lone mark", "ﬁ ligature Ⅷ", "word.,!?|"] + ["the same text again."] * 3


def brute(texts, length):
    whole = Tokenizer.from_file(tokenizer())
    return [[*whole.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def check(rows, expected, length):
    """Pieces give back every document's ids, and sequences are gapless and full but for the last."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_doc.setdefault(r["doc_id"], []).append((r["start"], ids.tolist()))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["doc_tokens"] == len(expected[r["doc_id"]])
    assert {d: sum((x for _, x in sorted(p)), []) for d, p in by_doc.items()} == expected
    for sequence, parts in by_sequence.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or sequence == max(by_sequence) and at < length
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("length", [2, 7, 2048])
def test_round_trip(spark, length):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, part string").repartition(3)
    check([r.asDict() for r in pack(spark, frame, tokenizer(), length, with_ids=True).collect()], dict(enumerate(brute(ODD, length))), length)


def test_same_ids_as_the_whole_tokenizer(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = [r.asDict() for r in QUERIES["op7_packing"](spark, sf_dir).collect()]
    expected = dict(zip(docs, brute(docs.values(), 2048), strict=True))
    for r in rows:
        ids = np.array(expected[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in rows) == sum(map(len, expected.values()))


def test_empty_table_and_repeated_ids(spark):
    assert pack(spark, spark.createDataFrame([], "doc_id long, text string"), tokenizer()).count() == 0
    rows = pack(spark, spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, text string"), tokenizer()).collect()
    assert sorted((r.doc_id is None, r.offset) for r in rows)[0][1] == 0 and sum(r.length for r in rows) == 6
