import io
import itertools
import json
import os
import random
import zipfile

import numpy as np
import pytest
from conftest import same_as_sql
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardloom import codecs
from shardloom.functions import requests, text
from shardloom.operators import batches, joins, ordered, scan, shards, sinks
from shardloom.plans import media as media_plans
from shardloom.sources import files, state


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_running_totals_over_partitions(spark):
    rnd = random.Random(2)
    data = [("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]), rnd.randrange(10_000), i, rnd.choice([None, 0, 1, 5])) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, o int, id int, v int")
    got = {r["id"]: r["s"] for r in ordered.running(df, ["g"], ["o", "id"], F.col("v"), "s").collect()}
    want, sums = {}, {}
    for g, o, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        sums[g] = want[i] = sums.get(g, 0) + (v or 0)
    assert got == want
    assert ordered.rank(df.limit(0), ["g"], ["o"]).count() == 0
    whole = ordered.rank(df, [], ["o", "id"])
    assert [r["rank"] for r in whole.orderBy("o", "id").collect()] == list(range(1, 3001))
    joined = ordered.with_group(df, df.groupBy("g").agg(F.count("*").alias("n")), "g", local=0)
    assert joined.count() == 3000 and joined.where("n is null").count() == 0


def test_requests(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    built = json.loads(one(requests.request_json(F.lit("r"), F.lit(None).cast("string"), F.lit('say "é"\n'))))
    assert built["messages"] == [{"role": "system", "content": ""}, {"role": "user", "content": 'say "é"\n'}] and built["response_format"] == {"type": "json_object"}
    assert "response_format" not in json.loads(one(requests.request_json(F.lit("r"), F.lit("s"), F.lit("u"), False)))
    for value in ({}, {"b": "x\"é", "a": "1"}, {"z_ü": "", "Z": "\n"}):
        entries = F.create_map(*(F.lit(x) for kv in value.items() for x in kv)) if value else F.lit(None).cast("map<string,string>")
        assert one(requests.map_hash(entries)) == requests.value_hash(value)
    assert requests.value_hash({"b": [1, {"d": 1, "c": 2}], "a": None}) == requests.value_hash({"a": None, "b": [1, {"c": 2, "d": 1}]})
    assert one(requests.data_uri(F.lit(b"x" * 100))).count("\n") == 0
    assert [one(requests.jpeg_quality(F.lit(q))) for q in (1, 80, 99)] == [30, 80, 95]
    assert one(requests.naive_render(F.lit("{a}{b}"), {"a": F.lit("{b}"), "b": F.lit("x")})) == "xx"
    assert [one(requests.backoff_seconds(F.lit(a), 2.0)) for a in (0, 2, 9)] == [2.0, 8.0, 30.0] and one(requests.backoff_seconds(F.lit(0), wait=F.lit(7))) == 7.0
    assert [one(requests.batch_count(F.lit(n), F.lit(k))) for n, k in ((0, 3), (7, 3), (7, 0), (6, 3))] == [0, 3, 0, 2]
    assert tuple(one(requests.progress(F.lit(0), F.lit(0), F.lit(0)))) == (None, None, None) and tuple(one(requests.progress(F.lit(5), F.lit(10), F.lit(2)))) == (50.0, 2.5, 2.0)
    assert one(requests.candidate_text(F.lit(""), F.array(F.lit("a"), F.lit(None), F.lit("b")), F.lit(True))) == "ab"
    assert tuple(one(requests.usage(F.lit('{"response": {"usage": {"prompt_tokens": 4, "total_tokens": "x"}}}')))) == (4, 0, 0) and tuple(one(requests.usage(F.lit(None).cast("string")))) == (0, 0, 0)
    assert [one(requests.valid_split(F.lit(n).cast("string"))) for n in ("train-1", "a b", "", None, "x\n")] == [True, False, False, False, False]
    assert [one(requests.valid_trigger(F.lit(n))) for n in ("a", "a=b", "a b")] == [True, False, False]
    assert [one(requests.known_upload(F.lit(n), "p.q")) for n in ("README.md", "p.q/chunk_1.zip", "pxq/chunk_1.zip", "p.q/chunk_1.zip.x")] == [True, True, False, False]
    assert [one(requests.in_window(F.lit(i), 2, e)) for i, e in ((1, 0), (9, 0), (3, 3), (4, 3))] == [False, True, True, False]
    assert tuple(one(text.file_reference(F.lit("https://huggingface.co/datasets/a/b/resolve/main/x/y.zip?d=1")))) == ("a/b", "x/y.zip")
    assert [one(text.lenient_reference(F.lit(a))) for a in ("https://huggingface.co/datasets/a/b/tree/main", "a/b/c", "a")] == ["a/b", "a/b", None]
    assert one(requests.frame_context(F.lit(" "), [F.lit("x"), F.lit(None).cast("string")], F.lit("t"))) == "Description: (no description)\nFrame 0: x\nFrame 1: (no tags)\nTags: t"


@settings(max_examples=60, deadline=None)
@given(sizes=st.lists(st.integers(1, 60), max_size=14), most=st.integers(40, 200), failing=st.integers(0, 4))
def test_posting_loses_no_request(sizes, most, failing):
    texts = [json.dumps({"id": i, "x": "y" * n}) for i, n in enumerate(sizes)]
    bare = [json.dumps({"id": i}) if i % 3 == 0 else None for i in range(len(sizes))]
    client, waits = batches.StubClient(most, failing), []
    got = batches.posted(client, "b", texts, bare, 10_000, 50, 4, waits.append)
    taken = [r["id"] for p in client.taken for r in json.loads(p)["batch_requests"]]
    assert len(got) == len(texts) and len(taken) == len(set(taken))
    assert sorted(taken) == [i for i, g in enumerate(got) if g[0] == "submitted"]
    for (s, code, stripped), t, b in zip(got, texts, bare):
        fits = len(batches.payload([t])) <= most or b is not None and len(batches.payload([b])) <= most
        assert fits or s == "failed_payload_too_large"
        assert s != "failed_payload_too_large" or not fits
        assert s != "failed_submit" or failing >= 4
        assert not stripped or b is not None
    assert all(w in (2.0, 4.0, 8.0) for w in waits)


def test_batches(spark):
    class Refusing(batches.StubClient):
        def post(self, batch, body):
            return 401

    assert {g[0] for g in batches.posted(Refusing(), "b", ["{}"] * 3, [None] * 3, sleep=lambda s: None)} == {"failed_submit"}
    df = spark.createDataFrame([("b", f"r{i:03d}", json.dumps({"id": i, "x": "z" * (i % 40)}), None) for i in range(200)], "batch_id string, request_id string, request string, bare string")
    out = batches.submit(df, lambda: batches.StubClient(400), "b", 600, wait=lambda s: None)
    assert out.count() == 200 and {r["state"] for r in out.collect()} == {"submitted"}
    ticks = itertools.count(0, 10)
    watch = lambda counts, **k: batches.watch(batches.StubClient(counts=counts), "b", sleep=lambda s: None, clock=lambda: float(next(ticks)), **k)
    assert watch([{"total": 0, "pending": 0}]) == "empty"
    assert watch([{"total": 5, "pending": 3}, {"total": 5, "pending": 0}]) == "done"
    assert watch([{"total": 1000, "pending": 5}]) == "tail"
    assert watch([{"total": 10, "pending": 5}], deadline=100) == "deadline"
    client = batches.StubClient(counts=[{"total": 1, "pending": 1}])
    assert batches.probe(client, "{}", sleep=lambda s: None, clock=lambda: float(next(ticks))) == "sync" and client.cancelled
    assert batches.probe(batches.StubClient(counts=[{"total": 1, "pending": 0}]), "{}") == "batch"
    found = {None: ([{"id": 1}, {"id": None}], "t"), "t": ([{"id": 2}], None)}
    assert [r["id"] for r in batches.pages(found.__getitem__)] == [1, 2]


def test_state_files(spark, tmp_path):
    at = str(tmp_path / "deep" / ".state_run_a.json")
    assert state.read_state(at) == {} and state.find_state(at, ".state_run_*.json") == at
    state.save_state(at, {"batch_id": "b", "request_map": {}})
    assert state.read_state("file://" + at) == {"batch_id": "b", "request_map": {}}
    for k, (name, held) in enumerate((("b", {"r": 1}), ("c", {"r": 2}), ("d", {}))):
        other = str(tmp_path / "deep" / f".state_run_{name}.json")
        state.save_state(other, {"request_map": held})
        os.utime(other, (1000 + k, 1000 + k))
    assert state.find_state(at, ".state_run_*.json").endswith("c.json") and state.find_state("file://" + at, ".state_run_*.json").startswith("file://")
    (tmp_path / "bad.json").write_text("[1")
    assert state.read_state(str(tmp_path / "bad.json")) == {} and not [f for f in os.listdir(tmp_path / "deep") if f.endswith(".part")]
    state.save_state(str(tmp_path / "log.json"), {"processed": {"p": {"taggers": ["b"], "processed_at": "2"}, "q": None}})
    log = state.read_log(spark, str(tmp_path / "log.json"))
    new = spark.createDataFrame([("p", ["a"], "1"), ("r", ["c"], "3"), ("p", None, None)], state.LOG_SCHEMA)
    assert rows(state.merge_log(log, new)) == [("p", ["a", "b"], "2"), ("r", ["c"], "3")]
    assert state.read_log(spark, str(tmp_path / "none.json")).count() == 0
    state.write_report(new.coalesce(1), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 3


def test_prompts(spark, tmp_path):
    for at, said in (("system_prompt.md", "root"), ("image/system_prompt.md", " mode\n"), ("image/anime/system_prompt.md", "profile")):
        (tmp_path / at).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / at).write_text(said)
    (tmp_path / "own.md").write_text("own")
    find = lambda *a, **k: files.prompt(str(tmp_path), "system", *a, **k)
    assert [find("image", "anime"), find("image", "x"), find("video", "x"), find("image", "anime", override=str(tmp_path / "own.md"))] == ["profile", "mode", "root", "own"]
    assert files.prompt(str(tmp_path), "user", "image", "x", default="constant") == "constant"
    with pytest.raises(FileNotFoundError):
        find("image", "x", override=str(tmp_path / "missing.md"))


def test_sinks(spark, tmp_path):
    made = spark.createDataFrame([(str(tmp_path / "a"), '{"x": 1}', "A"), (f"file://{tmp_path}/b", "{}", "B"), (str(tmp_path / "c"), "{}", None)], "stem string, json string, text string")
    assert [r["written"] for r in sinks.write_captions_with_json(made).collect()].count(True) == 2
    assert not any(r["written"] for r in sinks.write_captions_with_json(made).collect())
    assert (tmp_path / "b.txt").read_text() == "B\n" and (tmp_path / "a.json").read_text() == '{"x": 1}'
    assert sinks.write_sidecars(made.select("stem", F.lit("new").alias("text")), overwrite=False).where("written").count() == 1
    assert spark.range(1).select(sinks.similarity_json(F.lit(0.125)).alias("j")).first()["j"] == '{"combined":0.12}'
    assert spark.range(1).select(sinks.plain_caption(F.lit("x"), "p ").alias("j")).first()["j"] == "p x"


def archive(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in members:
            z.writestr(name, content)
    return out.getvalue()


def test_extraction(spark, tmp_path):
    data = [(str(tmp_path / "good.zip"), archive(("a/x.txt", "1"), ("y.txt", "2"))), (str(tmp_path / "slip.zip"), archive(("ok.txt", "1"), ("../out.txt", "2"))), (str(tmp_path / "broken.zip"), b"no zip"), (str(tmp_path / "null.zip"), None)]
    df = spark.createDataFrame(data, "path string, content binary")
    outcome = lambda: {os.path.basename(r["path"]): (r["outcome"], r["files"]) for r in shards.extract(df, str(tmp_path / "to")).collect()}
    assert outcome() == {"good.zip": ("extracted", 2), "slip.zip": ("failed", 0), "broken.zip": ("failed", 0), "null.zip": ("failed", 0)}
    assert (tmp_path / "to/good/a/x.txt").read_text() == "1" and not (tmp_path / "out.txt").exists() and not (tmp_path / "to/slip").exists()
    assert outcome()["good.zip"] == ("skipped", 0)
    assert [shards.tree(m) for m in ("a/../b", "../b", "/b", "C:/b", "a\\..\\..\\b", ".")] == ["b", None, None, None, None, None]
    info = spark.createDataFrame([("s", "p", 3, 10)], "shard string, path string, members bigint, bytes bigint")
    assert json.loads(shards.dataset_info(info, "train").first()["info"]) == {"split": "train", "shards": 1, "samples": 3, "bytes": 10}


def test_joins(spark):
    frames = spark.createDataFrame([("v", 1, "a"), ("v", 2, ""), ("w", 1, None), (None, 1, "n")], "video string, at int, tags string")
    every = spark.createDataFrame([("v",), ("x",)], "video string")
    assert rows(joins.frame_values(frames, "video", "tags", ["at"], every)) == [("v", "a"), ("x", "")]
    assert rows(joins.frame_values(frames, "video", "tags", ["at"])) == [("v", "a"), ("w", ""), (None, "n")]
    asked = spark.createDataFrame([("b", 1, "r1"), ("b", 2, "r2")], "g string, place int, id string")
    told = spark.createDataFrame([("b", 1, "x"), ("b", 3, "z"), ("c", 2, "y")], "g string, place int, v string")
    assert rows(joins.by_position(asked, told, "g", "place", "v")) == [("b", 1, "r1", "x"), ("b", 2, "r2", None)]
    res = spark.createDataFrame([("r1",), ("r2",), ("r3",), ("gone",)], "request_id string")
    req = spark.createDataFrame([("r1", "/a", "a"), ("r2", "/no", "b"), ("r3", "/no", "no")], "request_id string, path string, path_rel string")
    there = spark.createDataFrame([("/a",), ("a",), ("b",), (None,)], "path string")
    assert rows(joins.result_files(res, req, there)) == [("r1", "/a"), ("r2", "b"), ("r3", None)]
    assert rows(joins.result_files(res, req, there, True))[0] == ("r1", "a")
    pro = spark.createDataFrame([("v", 2, ["b", "c"]), ("v", 1, ["a", "b"]), ("v", 3, None)], "video string, at int, tags array<string>")
    assert joins.merged_extras(pro, "video", ["at"], "tags").first()["tags"] == ["a", "b", "c"]


def test_codecs(spark):
    raw = "r_frame_rate string, avg_frame_rate string, nb_frames string, duration string, channels int"
    df = spark.createDataFrame([("0/0", "25/1", "N/A", "2.5", 1), ("30000/1001", "25/1", "7", None, None), ("x", None, None, "3", 2)], raw).select(F.struct("*").alias("r"))
    got = [tuple(r[0]) for r in df.select(codecs.video_info(F.col("r"))).collect()]
    assert got[0] == (25.0, 62, 1) and got[1] == (pytest.approx(29.97, abs=0.01), 7, None) and got[2] == (0.0, 0, 2)
    wanted = spark.createDataFrame([(f"v{i}", 500 if i % 2 else 5) for i in range(40)] + [(None, 1)], "path string, frame int")
    out = codecs.extracted(wanted).collect()
    assert len(out) == 40 and {r["taken"] for r in out if r["content"] is not None} <= {0, 5} and all(r["taken"] == 0 for r in out if r["frame"] == 500 and r["content"])
    plan = spark.createDataFrame([(f"p{i}", True, i % 2 == 0, True) for i in range(64)], "path string, a boolean, b boolean, c boolean")
    done = {}
    for r in codecs.applied(plan, ["a", "b", "c"]).collect():
        done.setdefault(r["path"], []).append((r["stage"], r["ok"]))
    assert len(done) == 64 and all(ok for steps in done.values() for _, ok in steps[:-1]) and any(not steps[-1][1] for steps in done.values())
    grey = np.arange(60, dtype=np.uint8).reshape(6, 10)
    clear = np.dstack([np.full((6, 10, 3), 7, np.uint8), np.zeros((6, 10), np.uint8)])
    assert (codecs.over_white(clear) == 255).all() and codecs.over_white(grey).shape == (6, 10, 3)
    red = np.zeros((4, 8, 3), np.uint8)
    red[..., 0] = 200
    square = codecs.padded_square(red, 16)
    assert square.shape == (16, 16, 3) and square[8, 8].tolist() == [0, 0, 200] and square[0, 0].tolist() == [255, 255, 255]
    assert codecs.fitted(red, 32).shape == (3, 32, 32) and codecs.centred(red, 8)[0].max() == pytest.approx(200 / 127.5 - 1, abs=1e-5)
    assert np.allclose(codecs.resized(red, 4, 8), red)
    noise = np.random.default_rng(1).random((32, 32))
    assert codecs.structural_similarity(noise, noise) == pytest.approx(1) and codecs.structural_similarity(noise, 1 - noise) < 0
    pairs = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, "b")], "key bigint, a string, b string")
    method = lambda: lambda a, b: float("x") if a is None else 1.5 if a == b else 0.25
    assert [r["m"] for r in codecs.pair_scores(pairs, method, "m").orderBy("key").collect()] == [1.0, 0.25, 0.0]


def test_listings(spark):
    m = spark.createDataFrame([("/r/a.PNG", 3), ("/r/d/b.gif", 4), ("/r/a.PNG", 5), (None, 1), ("/r/x.txt", 0), ("/r/v.mp4", 2)], "path string, length bigint")
    assert rows(scan.media_of(m, (".png", ".gif"))) == [("/r/a.PNG", 5), ("/r/d/b.gif", 4)]
    assert rows(scan.at_path(m, "/r/", (".png", ".gif"), recursive=False)) == [("/r/a.PNG",)]
    assert rows(scan.at_path(m, "/r/x.txt", (".png",))) == [] and rows(scan.at_path(m, "/r/x.txt", (".png",), filter_file=False)) == [("/r/x.txt",)]
    assert [r["rel"] for r in scan.entries(m, "/r", "/tmp/q.json", 9).collect()] == ["_reports/q.json", "a.PNG", "d/b.gif", "v.mp4", "x.txt"]
    assert [r["rel"] for r in scan.entries(m, "/r", "/r/x.txt").collect()] == ["a.PNG", "d/b.gif", "v.mp4", "x.txt"]
    assert rows(scan.folders(m, ["/r"])) == [("/r", 2)]
    bad = spark.createDataFrame([("/r/x.png",), ("/r/x.png",), (None,)], "path string")
    assert rows(scan.delete_plan(bad, m)) == [("/r/x.png", "bad"), ("/r/x.txt", "sidecar")]


@pytest.mark.parametrize("name", ["contiguous_chunks", "entry_keys"])
def test_ordered_queries_with_many_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        same_as_sql(spark, name, media_plans)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
