"""A worker's memory doesn't grow with the rows of a batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from paywatch.llm import common, ngram_join, packing, quality_mil, sentencepiece_nbest

WORDS = ["alpha", "Beta", "gamma,", "delta.", "42", "épsilon", "zeta\n"]


def batch(rows):
    texts = [" ".join(WORDS[(i * j) % 7] for j in range(100)) for i in range(rows)]
    return pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int64()), pa.array(texts)], names=["doc_id", "text"])


def peak(run, rows):
    """MB at most while the results of one batch are taken and dropped."""
    tracemalloc.start()
    for _ in run(iter([rows])):
        pass
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most


def test_scores_of_a_large_batch():
    rows = batch(6000)
    x, _ = quality_mil.passages(rows.slice(0, 100).column("text"))
    run = quality_mil._score(quality_mil.Model.start(x, 0.5), quality_mil.WORDS, ["doc_id"], "score")
    assert peak(run, rows) < 60
    got = np.concatenate([part.column("score").to_numpy() for part in run(iter([rows]))])
    assert got.tolist() == [run(iter([rows.slice(i, 1)])).__next__().column("score")[0].as_py() for i in range(20)] + got[20:].tolist()


def test_codes_of_a_large_batch():
    rows = batch(6000)
    encode, decode = sentencepiece_nbest._encode(2, None), sentencepiece_nbest._decode(None)
    sentencepiece_nbest.loaded(None)
    assert peak(encode, rows) < 45
    coded = pa.Table.from_batches(list(encode(iter([rows])))).combine_chunks().to_batches()
    assert len(coded) == 1 and len(coded[0].column("ids").flatten()) > 500_000
    assert peak(decode, coded[0]) < 30
    assert [t for part in decode(iter(coded)) for t in part.column("decoded").to_pylist()] == rows.column("text").to_pylist()


def test_shingles_of_a_large_batch():
    rows = batch(6000)
    rows = pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(0)], names=["doc_id", "text", "key"])
    tables = np.ones(ngram_join.GRAMS + ngram_join.WORDS, np.uint32)
    assert peak(ngram_join._describe(5, 80, tables), rows) < 30
    keys = lambda of: [x for part in ngram_join._describe(5, 80, tables)(iter(of)) for x in part.column("sig1").to_pylist()]
    assert keys([rows])[:20] == keys([rows.slice(i, 1) for i in range(20)])


def test_kept_units_are_bounded():
    words = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghijklmn'[i // 1000 % 10]}{'opqrstuvwx'[i // 10000 % 10]}"
             f"{'yzabcdefgh'[i // 100000]}" for i in range(320_000)]
    ids = [packing.encode(pa.array([" ".join(words[a:a + 40_000])]))[0] for a in range(0, len(words), 40_000)]
    assert len(packing._known[None].numbers) <= packing.MEMORY + 40_000 < len(words)
    again = packing.encode(pa.array([" ".join(words[:40_000])]))[0]
    assert again.tolist() == ids[0].tolist()


def test_batches_are_limited_by_bytes(spark, tmp_path):
    spark.range(3000, numPartitions=1).selectExpr("id doc_id", "repeat(cast(id % 10 as string), 10000) text").write.parquet(
        f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for part in batches:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int64()), pa.array([part.nbytes], pa.int64())], names=["rows", "size"])

    found = common.table(spark, str(tmp_path), "documents").coalesce(1).mapInArrow(sizes, "rows long, size long").collect()
    assert sum(r.rows for r in found) == 3000 and max(r.size for r in found) < 2 * common.BATCH
