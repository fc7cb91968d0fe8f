import json
import os
import random
import subprocess
import sys
import zipfile

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardloom.functions import media, paths, results, tags, text
from shardloom.operators import compaction, jobs, scan, shards, similarity, sinks, tagging
from shardloom.plans import queries

from conftest import same_as_sql


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in zip(values, [_kind(v) for v in values.values()])))
    return df.select(column.alias("x")).first()["x"]


def _kind(v):
    return {str: "string", int: "bigint", float: "double", type(None): "string"}.get(type(v), "array<string>")


@pytest.mark.parametrize("raw, want", [("/a//b/./c/../d", "/a/b/d"), ("a\\b\\..\\c", "a/c"), ("/../x", "/x"), ("café/x", "café/x"), ("", ""), (None, None), ("/", "/")])
def test_plain_path(spark, raw, want):
    assert one(spark, paths.plain_path(F.col("p")), p=raw) == want


@pytest.mark.parametrize("path, ext, stem", [("/a/b.TXT", ".txt", "/a/b"), ("/a/.hidden", "", "/a/.hidden"), ("a.b/c", "", "a.b/c"), ("x.tar.gz", ".gz", "x.tar")])
def test_extension(spark, path, ext, stem):
    assert one(spark, paths.ext_of(F.col("p")), p=path) == ext
    assert one(spark, paths.stem_of(F.col("p")), p=path) == stem


def test_tags(spark):
    assert one(spark, tags.canonical_tag(F.col("t")), t="　Long__Hair ") == "long hair"
    assert one(spark, tags.canonical_tag(F.col("t")), t="@_@") == "@_@"
    assert one(spark, tags.canonical_tag(F.col("t")), t=" \t") is None
    assert tags.parse_replacements(r"a\,b,c;bad;x,y,z") == [("a,b", "c"), ("x", "y,z")]
    out = tags.postprocess(F.col("t"), "a_bc,x;a bc,y;y,z", ["no"], ["p", "q"])
    assert one(spark, out, t=["a_bc", "no", "q", "no", "p", "q"]) == ["q", "p", "z", "q"]
    assert one(spark, tags.expand_character(F.col("t")), t="a_(b)_(c)") == "a_(b), c"
    assert one(spark, tags.ordered_union(F.col("a"), F.col("b")), a=["x", "y", "x"], b=["y", "z"]) == ["x", "y", "z"]


@pytest.mark.parametrize("n, want", [(0, 1), (1, 1), (4, 1), (5, 9), (9, 9), (12, 9), (13, 17)])
def test_snap(spark, n, want):
    assert one(spark, media.snap_frames(F.col("n")), n=n) == want


def test_media(spark):
    assert one(spark, media.parse_fps(F.col("r")), r="30000/1001") == pytest.approx(29.97, abs=0.01)
    assert [one(spark, media.parse_fps(F.col("r")), r=r) for r in ("25", "1/0", "a/b", "1/2/3")] == [0, 0, 0, 0]
    assert one(spark, media.keyframes(F.col("n")), n=101) == [0, 25, 50, 75, 100]
    assert one(spark, media.keyframes(F.col("n")), n=0) == [0, 1, 2, 3, 4]
    assert one(spark, media.cut_seconds(F.col("f"), 121), f=24.0) == "5.0417"
    assert one(spark, media.trim_action(F.col("f"), F.lit(200), 121), f=0.0) == "probe_failed"
    assert one(spark, media.clamp_frame(F.lit(12), F.col("n")), n=5) == 4


def test_text(spark):
    assert one(spark, text.repo_name(F.col("n")), n="  My Repo!!--x. ") == "my-repo-x"
    assert one(spark, text.repo_name(F.col("n")), n="///") == "dataset"
    assert one(spark, text.render("{a} {b} {not it} {a}", {"a": F.col("a"), "b": F.lit("{a}")}), a="1") == "1 {a} {not it} 1"
    with pytest.raises(ValueError, match="b, c"):
        text.render("{c}{b}", {})
    assert text.parse_vars(["a=1=2", "a = 3"]) == {"a": "3"}
    assert one(spark, text.source_kind(F.col("s")), s="junk text") == "unknown"
    assert one(spark, text.error_line(F.col("e")), e="boom\nframe= 1\n") == "boom"
    assert one(spark, text.base_request_id(F.col("r")), r="req_x_a12") == "req_x"


@pytest.mark.parametrize(
    "raw, want",
    [
        ('{"caption": "a"}', ["a", "a", "a", "a"]),
        ('```json\n{"caption": "a"}\n```', ["a", "a", "a", "a"]),
        ('so: {"caption": "a"} ok', ["a", "a", "a", "a"]),
        ('{"caption": "a\\"b", "x', ['a"b', '{"caption": "a\\"b", "x', 'a"b', None]),
        ('{"x": 1}', ['{"x": 1}', '{"x": 1}', None, None]),
        ("plain", ["plain", "plain", "plain", None]),
        ("y" * 60, ["y" * 60] * 4),
    ],
)
def test_captions(spark, raw, want):
    assert [one(spark, results.caption_of(F.col("r"), v), r=raw) for v in (1, 2, 3, 4)] == want


def test_nested_answer(spark):
    deep = {"a": {"b": {"choices": [{"message": {"content": [{"type": "text", "text": "x"}, {"content": "y"}]}}]}}}
    assert one(spark, results.answer_text(F.col("r")), r=json.dumps(deep)) == "x\ny"
    assert one(spark, results.answer_text(F.col("r")), r="{") is None


@given(st.lists(st.integers(0, 30), max_size=40), st.integers(1, 20), st.integers(0, 5), st.booleans())
def test_next_fit(sizes, capacity, most, alone):
    shard = shards.next_fit(np.array(sizes, np.int64), capacity, most, alone)
    assert all(b - a in (0, 1) for a, b in zip(shard, shard[1:]))
    for k in set(shard.tolist()):
        held = [s for s, x in zip(sizes, shard) if x == k]
        assert sum(held) <= capacity or len([s for s in held if s]) == 1
        assert not most or len(held) <= most


def test_large_groups_are_cut(spark):
    df = spark.createDataFrame([("r", f"f{i:04d}", i % 7) for i in range(400)] + [("s", "x", 1), (None, "y", None)], "g string, o string, n bigint")
    out = shards.pack(df, "g", "o", F.col("n"), 20, large=100).collect()
    assert len(out) == 402 and len({r["range"] for r in out if r["g"] == "r"}) > 1
    assert shards.pack(df.limit(0), "g", "o", F.col("n"), 20).count() == 0


RULES = [{}, {"most": 3}, {"alone": False}, {"alone": False, "overhead": 5, "comma": 1}, {"most": 2, "alone": False}]


@given(st.lists(st.one_of(st.just(0), st.integers(0, 30)), max_size=40), st.integers(1, 40), st.sampled_from(RULES), st.lists(st.integers(1, 39), max_size=5))
def test_ranges_run_on(sizes, capacity, rule, cuts):
    whole = shards.next_fit(np.array(sizes, np.int64), capacity, **rule)
    state, got = shards.FIRST, []
    at = sorted({0, len(sizes), *(c for c in cuts if c < len(sizes))})
    for a, b in zip(at, at[1:]):
        part = np.array(sizes[a:b], np.int64)
        got += shards.next_fit(part, capacity, state=state, **rule).tolist()
        state = shards.run_on(state, shards.summary(part, capacity, **rule), capacity, **rule)
    assert got == whole.tolist()


@pytest.mark.parametrize("rule", RULES)
def test_large_groups_are_packed_as_one(spark, rule):
    rows = [("r", f"f{i:04d}", (i * 37) % 23) for i in range(400)] + [(None, f"n{i:04d}", i % 5) for i in range(150)] + [("r", None, 9), ("r", "f0007", 2), ("s", "x", 1)]
    df = spark.createDataFrame(rows, "g string, o string, n bigint")
    once, cut = (sorted(map(str, shards.pack(df, "g", "o", F.col("n"), 20, large=n, **rule).drop("range").collect())) for n in (10_000, 60))
    assert cut == once and len(cut) == 553


@pytest.mark.parametrize("name", ["pack_a", "pack_b", "pack_c", "pack_json_payload", "shard_keys"])
def test_shard_queries_with_large_groups_match_sql(spark, monkeypatch, name):
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    whole = shards.pack
    monkeypatch.setattr(shards, "pack", lambda *a, **k: whole(*a, large=8, **k))
    df = queries.queries()[name](spark, folder)
    con = duckdb.connect()
    for t in ("packing_input", "caption"):
        con.sql(f"create view {t} as from '{folder}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name]).df()[df.columns].itertuples(index=False, name=None)
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_archives(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "y", b"2"), ("a", 0, "x", b"1"), ("b", 0, "z", b"")], "shard string, seq int, name string, content binary")
    got = {r["shard"]: r for r in shards.write_archives(rows, str(tmp_path), "zip").collect()}
    with zipfile.ZipFile(got["a"]["path"]) as z:
        assert z.namelist() == ["x", "y"] and z.read("y") == b"2"
    files = spark.createDataFrame([(got["a"]["path"], open(got["a"]["path"], "rb").read()), ("bad", b"no")], "path string, content binary")
    assert {(r["member"], r["safe"]) for r in shards.unzipped(files).collect()} == {("x", True), ("y", True)}


def test_small_files(spark):
    rows = [("r", "/a/x.txt", 5, "2024-01-01"), ("r", "/a/./x.txt", None, "2024-01-02"), ("r", "/a/y.txt", 70000, "2024-01-01"), ("r", "/a/y.txt", 7, "2024-01-03"), ("r", "/a/.z", 5, "2024-01-01"), ("r", "/a/w.tmp", 5, "2024-01-01"), ("r", "/a/e", 0, "2024-01-01"), (None, None, 5, "2024-01-01")]
    m = spark.createDataFrame(rows, "repo string, path string, length bigint, t string").select("repo", "path", "length", F.col("t").cast("timestamp_ntz").alias("modification_time"))
    assert [r["path"] for r in compaction.small_files(m).collect()] == ["/a/y.txt"]
    assert compaction.consolidation_plan(m.limit(0)).count() == 0


def test_plan_covers_each_file_once(spark):
    rows = [(f"r{i % 3}", f"/d/{i:05d}", 1 + i % 900) for i in range(3000)]
    m = spark.createDataFrame(rows, "repo string, path string, length bigint").withColumn("modification_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    plan = compaction.consolidation_plan(m, target=20_000).collect()
    assert len(plan) == len({r["path"] for r in plan}) == 3000
    sizes = {}
    for r in plan:
        sizes[r["range"], r["file"]] = sizes.get((r["range"], r["file"]), 0) + r["length"]
    assert min(sizes.values()) > 10_000 and max(sizes.values()) < 30_000


def test_p3_found_goes_through_the_plan(spark, tmp_path, monkeypatch):
    rows = [("r", "/a/x", 5), ("r", "/a/./x", 6), ("r", "/a/y", 70_000), ("s", "/a/z", 9)]
    m = spark.createDataFrame(rows, "repo string, path string, length bigint").withColumn("modification_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    m.write.parquet(str(tmp_path / "manifest.parquet"))
    planned = []
    plan = compaction.consolidation_plan
    monkeypatch.setattr(compaction, "consolidation_plan", lambda *a: planned.append(plan(*a)) or planned[-1])
    found = queries.queries()["p3_found"](spark, str(tmp_path))
    assert sorted(r["path"] for r in found.collect()) == ["/a/x", "/a/z"]
    assert [p.count() for p in planned] == [2]


def test_compact(spark, tmp_path):
    folder = str(tmp_path / "t")
    data = [(i, None if i % 5 == 0 else f"v{i}") for i in range(500)]
    spark.createDataFrame(data, "k int, v string").repartition(20).write.parquet(folder)
    before, after = compaction.compact(spark, folder, ["k"])
    assert (before, after) == (20, 1)
    assert sorted(map(tuple, spark.read.parquet(folder).collect())) == data
    assert not [f for f in os.listdir(tmp_path) if f.startswith(".")]


def test_compact_keeps_layout_and_splits_a_hot_key(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = [("hot" if i % 4 else f"k{i}", i % 2, {"a": str(i), "b": None}, [{"x": {i: i}}]) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, p int, m map<string,string>, n array<struct<x: map<int,int>>>")
    df.repartition(8).write.partitionBy("p").parquet(folder)
    size = sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))
    before, after = compaction.compact(spark, folder, ["k"], size // 4)
    again = spark.read.parquet(folder)
    assert before == 16 and 4 <= after <= 12 and sorted(os.listdir(folder))[-2:] == ["p=0", "p=1"]
    assert again.count() == 4000 and again.where("k = 'hot'").select(F.input_file_name()).distinct().count() > 2
    assert compaction.fingerprint(again) == compaction.fingerprint(df)


def test_fingerprint_sees_maps_and_nulls(spark):
    kind = "a string, m map<string,string>, s struct<m: map<string,string>>"
    base = [("x", {"k": "v", "l": "w"}, ({"k": "1"},)), (None, None, None)]
    sums = [compaction.fingerprint(spark.createDataFrame(rows, kind)) for rows in (
        base, [("x", {"l": "w", "k": "v"}, ({"k": "1"},)), base[1]], [("x", {"k": "v", "l": "u"}, ({"k": "1"},)), base[1]], [("x", {"k": "v", "l": "w"}, ({"k": "2"},)), base[1]], [base[0], (None, {}, None)], [*base, base[0]], [])]
    assert sums[0] == sums[1] and len(set(sums)) == 6
    assert compaction.fingerprint(spark.range(3).select()) == (3, 0)


@pytest.mark.parametrize("step, outcome", [("written", "undone"), ("begun", "undone"), ("moved", "finished"), ("swapped", "finished")])
def test_a_swap_that_broke_off_is_recovered(spark, tmp_path, step, outcome):
    folder = str(tmp_path / "t")
    df = spark.createDataFrame([(i,) for i in range(10)], "k int")
    df.repartition(5).write.parquet(folder)
    f = compaction._Folders(spark, folder)
    df.coalesce(1).write.parquet(f.new.toString())
    if step != "written":
        f.begin()
    if step in ("moved", "swapped"):
        os.rename(folder, str(tmp_path / ".t-old"))
    if step == "swapped":
        os.rename(str(tmp_path / ".t-new"), folder)
    assert compaction.recover(spark, folder) == outcome and compaction.recover(spark, folder) == "none"
    assert spark.read.parquet(folder).count() == 10 and os.listdir(tmp_path) == ["t"]
    assert compaction.compact(spark, folder, ["k"])[1] == 1


def test_scan(spark):
    m = spark.createDataFrame([(p,) for p in ("/a/x.PNG", "/a/x.jpg", "/a/x.txt", "/a/y.mp4", "/b/x.jpg", "/b/n.txt", None, "/a/x.txt", "/b/x_2.jpg", "/c/x.jpg")], "path string")
    pairs = {r["stem"]: (r["media"], r["texts"], r["state"]) for r in scan.media_pairs(m).collect()}
    assert pairs["/a/x"] == (2, 1, "paired") and pairs["/b/n"] == (0, 1, "text_only") and pairs["/a/y"] == (1, 0, "media_only")
    names = [r["name"] for r in scan.flatten_plan(m).collect()]
    assert len(names) == len(set(names)) == 6


def test_taggers(spark):
    v = spark.createDataFrame([(1, [9.0, 9.0, 0.0, 9.0])], "vec_id bigint, e array<double>")
    vocab = spark.createDataFrame([(0, "a", "0"), (1, "b", "4"), (2, "c", "0"), (3, "d", "4")], "idx int, name string, category string")
    p = tagging.scores(v, "vec_id", "e", 1.0)
    assert tagging.threshold_tags(p, vocab, "vec_id").first()["tags"] == ["d", "b", "a", "c"]
    assert tagging.split_tags(p, vocab, "vec_id", 1, general=0.5).first()["tags"] == ["a", "b", "d"]
    assert tagging.rating(v, "vec_id", "e", ["x", "y"]).first()["rating"] == "x"
    assert [r["name"] for r in tagging.top_tags(v, vocab, "vec_id", "e", 2, 1, 2).orderBy("rank").collect()] == ["a", "d", "c"]


def test_threshold_resolution(spark):
    duckdb = pytest.importorskip("duckdb")
    levels = [(0.0, 0.5, 0.6, 0.7), (None, 0.5, 0.6, 0.7), (None, None, 0.6, 0.7), (None, None, None, 0.7), (None, None, None, None)]
    df = spark.createDataFrame(levels, "a double, b double, c double, d double")
    assert [r[0] for r in df.select(tagging.resolved_threshold(*(F.col(c) for c in "abcd"))).collect()] == [0.0, 0.5, 0.6, 0.7, 0.35]
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    con = duckdb.connect()
    con.sql(f"create view part as from '{folder}/part.parquet'")
    want = con.sql(queries.oracle_sql()["threshold_resolution"]).fetchall()
    assert sorted(map(tuple, queries.queries()["threshold_resolution"](spark, folder).collect())) == sorted(want)


def test_jobs(spark):
    log = spark.createDataFrame([(1, "r_a1", "failed", 1, "m", "b", 1.0, "p"), (2, "r_a1", "submitted", 1, None, "b", 2.0, "p"), (3, "s", "failed", None, "m", "b", 1.0, "q")], "log_id bigint, request_id string, state string, attempt int, error_message string, batch_id string, updated_at double, path_rel string")
    assert {r["base_id"]: r["next_id"] for r in jobs.attempts(log).collect()} == {"r": None, "s": "s_a1"}
    assert jobs.counters(log).first()["pending"] == 1
    assert [r["path_rel"] for r in jobs.failed_paths(log).collect()] == ["q"]
    times = sorted(random.Random(1).sample(range(1000), 80))
    calls = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, s int").select("id", F.timestamp_seconds("s").alias("at"))
    got = {r["id"]: r["calls"] for r in jobs.rolling_count(calls, "at", 30, "id").collect()}
    assert got == {i: sum(t - 30 <= u <= t for u in times) for i, t in enumerate(times)}


def test_similarity_and_sinks(spark, tmp_path):
    assert one(spark, similarity.combined({"clip": F.lit(1.0), "ssim": F.col("s")}), s=0.0) == pytest.approx(61.5385, abs=1e-4)
    assert one(spark, similarity.combined({}) if False else similarity.combined({"x": F.col("s")}), s=0.5) == 50.0
    assert one(spark, sinks.caption_line(F.col("t"), ", ", F.lit("b, ,a"), "p"), t=["a", "c", "c"]) == "p, b, a, c, c"
    done = sinks.write_sidecars(spark.createDataFrame([(str(tmp_path / "f"), "hi"), (str(tmp_path / "g"), None)], "stem string, text string")).collect()
    assert [r["written"] for r in done] == [True, False] and (tmp_path / "f.txt").read_text() == "hi\n"


def test_queries_are_readable_without_a_session():
    code = "import __spark_entry__ as e, pyspark; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and all(map(callable, q.values())); assert pyspark.SparkContext._active_spark_context is None"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, name):
    same_as_sql(spark, name, queries)
