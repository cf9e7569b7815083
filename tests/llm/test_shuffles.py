"""What line de-duplication and the n-gram join put into their exchanges and stages."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from callsheet.llm import keyfilter, line_dedup, ngram_join

TEXT = "one line that is long enough\nand another one as long"


def bitmap(keys):
    bits = np.zeros(1 << 13, np.uint8)
    at = keyfilter._places(np.array(keys, np.int64), len(bits) * 8)
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return SimpleNamespace(value=bits)


def lists(*lines):
    return pa.RecordBatch.from_arrays([pa.array(range(len(lines)), pa.int64()), pa.array(range(len(lines)), pa.int64()), pa.array(lines, pa.list_(pa.int64())), pa.array([[30] * len(x) for x in lines], pa.list_(pa.int32()))],
                                      names=["id", "key", "lines", "size"])


def test_only_names_of_runs_travel_to_be_counted():
    batch = lists([1, 2, 1], [2], [])
    named = list(line_dedup._runs(iter([batch]), 20))
    assert {tuple(b.schema.names) for b in named} == {("run",)}
    held = [r for b in line_dedup._runs(iter([batch]), 20, bitmap([r["run"] for b in named for r in b.to_pylist()])) for r in b.to_pylist()]
    # each run of a document once; held ones in each place
    assert sorted(r["run"] for b in named for r in b.to_pylist()) == sorted(x for x, _ in {(r["run"], r["key"]) for r in held})
    assert sorted((r["key"], r["start"], r["stop"]) for r in held) == [(0, 0, 1), (0, 0, 2), (0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 0, 1)]


def test_lines_that_go_are_dealt_by_key_at_any_size(spark):
    df = spark.createDataFrame([(i, f"{TEXT}\ndocument {i} has this line of its own") for i in range(20)], "doc_id long, text string")
    out = line_dedup.remove_shared_lines(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan
    assert sorted(r._n_removed for r in out.collect()) == [0] + [2] * 19


def test_points_travel_as_they_are():
    rng = np.random.default_rng(1)
    points = [ngram_join.counted(rng.integers(0, 1 << 40, n).astype(np.uint64)) for n in (0, 1, 100, 3000)] + [bytes([16] + [0] * 127)]
    small = [ngram_join._small(p) for p in points]
    assert ngram_join._large(pa.array(small, pa.binary())) == points
    assert len(small[3]) < 0.95 * 8192 * 1.25 / 8  # one count takes more than a bit, two together less than twice that


def test_the_first_shingles_of_shared_sets_only():
    sets = [np.sort(np.random.default_rng(i).integers(1, 1 << 62, 40)).astype(np.uint64) for i in (1, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6, 5], pa.int64()), pa.array([ngram_join._packed(sets[i]) for i in (0, 1, 0)], pa.binary()), pa.array([50, 60, 51], pa.int64())], names=["node", "items", "key"])
    none = SimpleNamespace(value=np.zeros(0, np.uint64))
    leads = bitmap([50, 60])
    one = [b.to_pylist() for b in ngram_join._leading(iter([batch]), leads, lambda x: x)]
    assert [[r["node"] for r in b] for b in one] == [[5, 6]] and set(one[0][0]) == {"node", "items"}
    pairs = batch.select(["node", "items"])
    named = list(ngram_join._prefixes(iter([pairs]), none))
    assert {tuple(b.schema.names) for b in named} == {("shingle",)}
    names = [r["shingle"] for b in named for r in b.to_pylist()]
    got = [r for b in ngram_join._prefixes(iter([pairs]), none, bitmap(names[:3])) for r in b.to_pylist()]
    assert [r["shingle"] for r in got] == names[:3] and {r["node"] for r in got} == {5}


def test_middle_sized_cells_are_searched_in_full_at_once():
    n = 60
    h = np.sort(np.random.default_rng(3).integers(1, 1 << 40, 100)).astype(np.uint64)
    point = ngram_join._small(ngram_join.counted(h))
    node = list(range(n))
    table = pa.RecordBatch.from_arrays([pa.array([7] * n, pa.int64()), pa.array([0] * n, pa.int32()), pa.array(node, pa.int64()), pa.array(node, pa.int64()), pa.array([100] * n, pa.int64()), pa.array([point] * n, pa.binary())],
                                       names=["cell", "side", "node", "root", "n", "point"])
    assert ngram_join.SMALL_CELL < n <= ngram_join.WHOLE_CELL
    got = {(r["a"], r["b"]) for b in ngram_join._searched(iter([table]), True) for r in b.to_pylist()}
    assert got == {(a, b) for a in node for b in node if a < b}
