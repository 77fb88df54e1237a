"""Whole results where the second review found cuts, against plain versions."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paywatch.llm import line_dedup, packing
from paywatch.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.test_operators import check_packing

FOLDER = "/root/testdata/sf0.001"


def short_passages():
    rng = random.Random(3)
    passages = [[f"passage {p} line {j}" for j in range(2 + p % 4)] for p in range(12)]
    out = []
    for d in range(60):
        lines = [f"own {d} head"]
        for p in rng.sample(passages, 3):
            lines += p + [f"own {d} {rng.random()}"]
        out.append((d, "\n".join(lines)))
    return out + [(100, "x\nx\nx\nx"), (101, "q\n\n\nr"), (102, "s\n\n\nt"), (103, None), (104, ""), (105, "own 0 head")]


@pytest.fixture(scope="module")
def line_rows(spark):
    return spark.createDataFrame(short_passages(), "doc_id long, text string")


def test_repeated_runs_go_whole(line_rows):
    out = {r.doc_id: r for r in line_dedup.dedup_lines(line_rows).collect()}
    assert {d: r.text for d, r in out.items()} == plain.without_repeated_runs(short_passages())
    kept = [x for d, r in out.items() if d < 60 for x in r.text.split("\n") if x.startswith("passage")]
    assert len(kept) == len(set(kept)) == sum(2 + p % 4 for p in range(12))
    for d, t in short_passages():
        assert out[d].removed_lines == len((t or "").split("\n")) - len((out[d].text or "").split("\n"))
    assert out[100].text == "x\nx" and out[103].text is None


def test_line_query_leaves_no_repeated_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = plain.without_repeated_runs(sorted((r.doc_id, r.text) for r in docs))
    out = QUERIES["op9_line_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: r.text_sha256 for r in out} == {d: plain.sha(t) for d, t in want.items()}


@pytest.mark.parametrize("mean_lines", [1, 3, 1000])
def test_one_of_the_texts_that_share_an_id_keeps_a_chunk(spark, mean_lines):
    head = "\n".join(f"license {i}" for i in range(40))
    rows = [(d, f"{head}\nown {i}") for i, d in enumerate([None] * 5 + [7] * 5)]
    out = [r.removed_lines for r in line_dedup.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string"), mean_lines).collect()]
    assert sorted(out)[0] == 0 and sorted(out)[1] >= 40


def wanted(docs):
    """(doc_id, ids) of each document, as check_packing wants them."""
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [(d, t.encode(x or "", add_special_tokens=False).ids + [1]) for d, x in docs]


def distances(pieces):
    """Total variation between each full window and the shares of the queues in all tokens."""
    totals, windows = Counter(), defaultdict(Counter)
    for p in pieces:
        totals[p.queue] += p.length
        windows[p.sequence_id][p.queue] += p.length
    whole = sum(totals.values())
    return [sum(abs(windows[w][q] / 2048 - t / whole) for q, t in totals.items()) / 2 for w in range(max(windows))]


def test_each_window_holds_the_targets(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pieces = packing.pack(docs).collect()
    found = distances(pieces)
    assert len(found) > 20 and max(found) < 0.03
    assert min(distances(packing.pack(docs, quantum=256).collect())) > 0.2  # what a fixed quantum gave
    check_packing(pieces, wanted((r.doc_id, r.text) for r in docs.collect()))


def test_serving_order_of_shares_against_a_sort():
    totals = [100_000, 37, 5, 40_961, 1, 9_000]
    counts = packing.quanta_of(totals, 2048)
    assert counts == [74, 2, 1, 74, 1, 74]
    at = 0
    for _, i, k in sorted(((k + 1) / m, i, k) for i, m in enumerate(counts) for k in range(m)):
        ends = [j * totals[i] // counts[i] for j in (k, k + 1)]
        assert packing.due_before_quanta(packing.np.array([k]), i, totals, counts).tolist() == [at]
        at += ends[1] - ends[0]
    assert at == sum(totals)


def test_each_of_many_sources_holds_its_share(spark):
    docs = [(i, " ".join(f"w{(i * 7 + j) % 97}" for j in range(60)), f"s{i % 400}" if i % 3 else "hot") for i in range(2400)]
    pieces = packing.pack(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)).collect()
    check_packing(pieces, wanted((d, t) for d, t, _ in docs))
    totals, served, so_far = Counter(), defaultdict(Counter), Counter()
    for p in pieces:
        totals[p.queue] += p.length
        served[p.sequence_id][p.queue] += p.length
    whole = sum(totals.values())
    assert len(totals) == 401 and len(served) > 100
    for w in range(max(served)):
        so_far.update(served[w])
        for q, t in totals.items():
            assert abs(so_far[q] - (w + 1) * 2048 * t / whole) <= max(64, 2048 * t / whole), q  # a quantum
        assert abs(served[w]["=hot"] - 2048 * totals["=hot"] / whole) < 8
