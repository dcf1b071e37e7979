import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loomspark.operators import clips as P
from loomspark.operators import intervals as V
from loomspark.operators import lineage as N
from loomspark.operators import manifest as M
from loomspark.operators import metrics as K
from loomspark.operators import pools as G
from loomspark.operators import sampling as S
from loomspark.operators import segmentation as W
from loomspark.operators import timeline as L
from loomspark.plans.runner import StageRunner, cached_transform, fingerprint, same_rows, table_fingerprint
from loomspark.sources import readers, writers


def intervals(seed, n=60, span=400, longest=60):
    rng = random.Random(seed)
    return [(k, a, a + rng.randint(0, longest)) for k in range(3) for a in (rng.randint(0, span) for _ in range(n // 3))]


def by_key(rows):
    return {k: sorted((s, e) for q, s, e in rows if q == k) for k in sorted({r[0] for r in rows})}


@pytest.mark.parametrize("seed", range(4))
def test_pack_is_the_greedy_loop(spark, seed):
    rows, cap, gap = intervals(seed), 50, 6
    got = by_key([(r.k, r.start, r.end) for r in V.pack(spark.createDataFrame(rows, "k int, start long, end long"), ["k"], cap, gap).collect()])
    for k, own in by_key(rows).items():
        pieces = []
        for s, e in own:
            while e - s > cap:
                pieces.append((s, s + cap))
                s += cap
            if e > s:
                pieces.append((s, e))
        out = []
        for s, e in sorted(pieces):
            if out and max(0, s - out[-1][1]) <= gap and e - out[-1][0] <= cap:
                out[-1] = (out[-1][0], max(out[-1][1], e))
            else:
                out.append((s, e))
        assert got[k] == sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_pack_events_is_the_loop(spark, seed):
    rows, most, least, slack = intervals(seed, longest=90), 40, 10, 3
    got = by_key([(r.k, r.start, r.end) for r in V.pack_events(spark.createDataFrame(rows, "k int, start long, end long"), ["k"], most, least, slack).collect()])
    for k, own in by_key(rows).items():
        out, now, last = [], None, None
        for s, e in own:
            if now and last is not None and abs(s - last) <= slack and e - now[0] <= most:
                now = (now[0], e)
            else:
                if now and now[1] - now[0] >= least:
                    out.append(now)
                while e - s > most:
                    out.append((s, s + most))
                    s += most
                now = (s, e)
            last = e
        if now and now[1] - now[0] >= least:
            out.append(now)
        assert got.get(k, []) == sorted(out)


def test_complement_covers_the_rest(spark):
    rows = spark.createDataFrame([(1, 5, 10), (1, 8, 20), (1, 30, 50), (2, 0, 100)], "k int, start long, end long")
    limits = spark.createDataFrame([(1, 60), (2, 100), (3, 7)], "k int, limit long")
    got = sorted(tuple(r) for r in V.complement(rows, ["k"], limits, 5).collect())
    assert got == [(1, 0, 5), (1, 20, 30), (1, 50, 60), (3, 0, 7)]


def test_segment_has_no_overlap(spark):
    rows = spark.createDataFrame(intervals(9), "k int, start long, end long")
    limits = spark.createDataFrame([(k, 500) for k in range(3)], "k int, limit long")
    found = by_key([tuple(r) for r in V.segment(rows, ["k"], limits, 60, 5, 4, 2).collect()])
    for own in found.values():
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:])) and all(0 <= s <= e <= 500 for s, e in own)


def spaced(cuts, duration, shortest):
    """Brute force: looks for the first short piece from the start again after each cut taken out."""
    ends = [(0.0, None), *[c for c in cuts if shortest <= c[0] <= duration - shortest], (duration, None)]
    while True:
        for i in range(len(ends) - 1):
            if len(ends) > 2 and ends[i + 1][0] - ends[i][0] < shortest - 1e-9:
                left, right = ends[i][1], ends[i + 1][1]
                ends.pop(i + 1 if left is None or (right is not None and left > right) else i)
                break
        else:
            return ends[1:-1]


def halved(ends, pool, rms, limits):
    """Brute force: cuts the first piece that is too long, again and again."""
    ends = list(ends)
    while True:
        for a, b in zip(ends, ends[1:]):
            if b - a > limits.longest:
                break
        else:
            return ends
        fits = [(s * (0.55 + 0.45 * math.sin(math.pi * (t - a) / (b - a))), -abs(t - (a + b) / 2), -t) for t, s in pool if t - a >= limits.shortest and b - t >= limits.shortest]
        if fits:
            at = -max(fits)[2]
        else:
            lo, hi = max(1, math.ceil((a + (b - a) / 4) / limits.hop)), min(len(rms) - 2, math.floor((b - (b - a) / 4) / limits.hop))
            at = min(range(lo, hi + 1), key=lambda k: (rms[k], k)) * limits.hop
        ends = sorted([*ends, at])


@pytest.mark.parametrize("seed", range(4))
def test_cuts_are_the_brute_force(spark, seed):
    rng = random.Random(seed)
    limits = W.Limits(hop=0.1, longest=6.0)
    sets = [(k, sorted({(round(rng.uniform(0.1, 59), 3), float(rng.randint(0, 5))) for _ in range(rng.randint(0, 40))})) for k in range(12)]
    rows = spark.createDataFrame([(k, [(t, s, "r") for t, s in cuts]) for k, cuts in sets], "k int, cuts array<struct<time:double,score:double,reason:string>>")
    kept = {r.k: [(c.time, c.score) for c in r.kept] for r in rows.select("k", W.spaced(F.col("cuts"), F.lit(60.0), 1.2).alias("kept")).collect()}
    rms = np.array([rng.random() for _ in range(600)])
    for k, cuts in sets:
        assert kept[k] == spaced(cuts, 60.0, 1.2)
        ends = [0.0, *[t for t, _ in kept[k]], 60.0]
        assert all(b - a >= 1.2 - 1e-9 for a, b in zip(ends, ends[1:]))
        times, scores = (np.array([c[i] for c in cuts]) for i in (0, 1))
        more = [t for a, b in zip(ends, ends[1:]) for t, _ in W.halved(a, b, times, scores, rms, limits)]
        assert sorted([*ends, *more]) == pytest.approx(halved(ends, cuts, rms, limits))


def test_fragments_of_sound(spark):
    rng = random.Random(1)
    limits = W.Limits(hop=0.1, shortest=0.5, longest=3.0, envelope=2.0, pause=0.2)
    frames, sizes = [], {"a": 300, "b": 3, "c": 90}
    for k, n in sizes.items():
        for i in range(n):
            quiet = k == "a" and 100 <= i < 105
            frames.append((k, i, -60.0 if quiet else -10.0 - rng.random(), rng.random(), rng.random() * 0.2, rng.random()))
    durations = spark.createDataFrame([(k, n / 10) for k, n in sizes.items()] + [("empty", 9.0)], "k string, duration double")
    found = W.segment_frames(spark.createDataFrame(frames, "k string, idx int, rms double, flux double, novelty double, step double"), durations, "k", limits)
    got = {}
    for r in found.orderBy("k", "start").collect():
        got.setdefault(r.k, []).append(r)
    assert set(got) == {*sizes, "empty"} and len(got["b"]) == len(got["empty"]) == 1
    for k, own in got.items():
        assert own[0].start == 0 and own[-1].end == pytest.approx({**{k: n / 10 for k, n in sizes.items()}, "empty": 9.0}[k])
        assert all(x.end == y.start and x.right_reason == y.left_reason for x, y in zip(own, own[1:]))
        assert k == "empty" or all(r.end - r.start <= limits.longest for r in own)
    assert any(r.right_reason == "pause_valley" and 10.0 <= r.end < 10.5 and r.right_score > 3 for r in got["a"])
    with pytest.raises(ValueError):
        W.Limits(longest=1.0)


def test_edges_move_until_quiet():
    rate, limits = 1000, P.ClipLimits(shortest=0.5, longest=4.0, extension=1.0, hold=0.1, quiet_db=-40.0)
    sound = np.zeros(10_000, dtype="float32")
    sound[800:3400] = 0.5  # sound runs on beyond both edges of the first segment
    sound[5000:9900] = 0.5
    start, end = P.widened(np.array([1.0, 5.5, 8.0]), np.array([3.0, 7.0, 9.5]), sound, rate, limits)
    assert start[0] == pytest.approx(0.7) and end[0] == pytest.approx(3.5)  # 0.1 s beyond the last loud frame
    assert start[1] == pytest.approx(4.9) and end[1] == pytest.approx(8.0)  # held by the next segment
    assert start[2] == pytest.approx(8.0) and end[2] == pytest.approx(10.0)
    assert P.first_quiet(np.array([1, 0, 1, 0, 0, 0]), 0.5, 2) == 3 and P.first_quiet(np.ones(3), 0.5, 2) is None


def test_event_clips_of_gaps(spark):
    sources = spark.createDataFrame([(1, 9, "a.wav", 30.0, 16000), (2, 9, "b.wav", 30.0, 16000)], "source_uid long, speaker_id long, path string, duration double, sample_rate int")
    speech = spark.createDataFrame([(1, 0.0, 10.0), (1, 12.0, 13.0)], "source_uid long, start double, end double")
    gaps = P.quiet_gaps(sources, speech)
    assert [tuple(r) for r in gaps.collect()] == [(1, 13.0, 30.0)]
    assert [r.source_uid for r in P.missing_regions(sources, speech).collect()] == [2]
    frames = [(1, i, 0.5 if 1500 <= i < 2000 else 1e-5, -6.0 if 1500 <= i < 2000 else -100.0, 0.0, 0.0, 0.0) for i in range(3000)]
    fragments = P.gap_fragments(gaps, spark.createDataFrame(frames, "source_uid long, idx int, amplitude double, rms double, flux double, novelty double, step double"))
    rows = sorted((r.start, r.end) for r in fragments.collect())
    assert rows[0][0] == 13.0 and rows[-1][1] == pytest.approx(30.0) and all(x[1] == pytest.approx(y[0]) for x, y in zip(rows, rows[1:]))
    clips = P.event_clips(sources, fragments, P.ClipLimits(shortest=0.6, longest=20.0)).collect()
    assert clips and all(c.origin == "vad_complement" and "_nv_" in c.id and c.start >= 12.8 for c in clips)
    assert any(c.start < 15.0 and c.end > 19.9 for c in clips)


def test_latent_merge_refusals_and_paths(spark):
    df = spark.createDataFrame([(1, "a/./x.pt", "t", "S:rj12_take", " i ", 5), (2, "/abs/../q/y.pt", "u", "other", "", 6)], "line int, latent_path string, text string, speaker_id string, id string, extra int")
    other = spark.createDataFrame([(1, "../d/B.pt", "t", 7)], "line int, latent_path string, text string, speaker_id int")
    merged = N.merge_latents({"/r/m/one.jsonl": df, "/r/n/two.jsonl": other}, "/r/out/all.jsonl", collapse_speakers=True)
    assert [r.latent_path for r in merged.rows.collect()] == ["../../q/y.pt", "../d/B.pt", "../m/a/x.pt"]
    assert merged.input_counts == {"/r/m/one.jsonl": 2, "/r/n/two.jsonl": 1} and merged.speaker_normalized_count == 2 and "extra" in merged.rows.columns
    clash = spark.createDataFrame([(7, "../m/a/x.pt", "t")], "line int, latent_path string, text string")
    with pytest.raises(ValueError, match=r"/r/m/one.jsonl:1 and /r/n/two.jsonl:7"):
        N.merge_latents({"/r/m/one.jsonl": df, "/r/n/two.jsonl": clash}, "/r/out/all.jsonl")
    same_id = spark.createDataFrame([(3, "z.pt", "t", "i")], "line int, latent_path string, text string, id string")
    with pytest.raises(ValueError, match="duplicate id"):
        N.merge_latents({"/r/m/one.jsonl": df, "/r/n/two.jsonl": same_id}, "/r/out/all.jsonl")
    for bad in ({}, {"/r/out/all.jsonl": df}, {"/r/m/x.jsonl": df.drop("text")}, {"/r/m/x.jsonl": df.withColumn("latent_path", F.lit(" "))}):
        with pytest.raises(ValueError):
            N.merge_latents(bad, "/r/out/all.jsonl")
    with pytest.raises(FileNotFoundError, match="one.jsonl:2"):
        N.merge_latents({"/r/m/one.jsonl": df}, "/r/out/all.jsonl", existing=spark.createDataFrame([("/r/m/a/x.pt",)], "path string"))


def test_pools_refuse_what_is_not_there(spark):
    index = spark.createDataFrame([(i, "s" if i < 3 else None, "c" if i else None) for i in range(5)], "idx int, speaker_id string, category string")
    with pytest.raises(ValueError, match="9"):
        G.subset(index, spark.createDataFrame([(1,), (9,)], "idx int"))
    with pytest.raises(ValueError):
        G.subset(index, spark.createDataFrame([], "idx int"))
    assert sorted(r.idx for r in G.style_filtered(index).collect()) == [1, 2]
    with pytest.raises(ValueError):
        G.style_filtered(index.where("idx = 0"))
    got = {r.idx: r.reference for r in G.picked_references(index, "idx", "speaker_id", "category", 1).collect()}
    assert got[0] in (1, 2) and {got[1], got[2]} == {1, 2} and got[1] == 2 and got[3] is None


def test_context_windows_are_the_slices(spark):
    rows = spark.createDataFrame([(c, t) for c, n in ((1, 7), (2, 1), (3, 33)) for t in range(n)], "c int, t int")
    shown = L.windows(L.positions(rows, "c", ["t"]), "c", target=4, context=6)
    got = {(r.c, r.ordinal, r.pos): r.role for r in shown.collect()}
    want = {}
    for c, n in ((1, 7), (2, 1), (3, 33)):
        for o in range(-(-n // 4)):
            for p in range(max(0, o * 4 - 6), min(n, min(n, o * 4 + 4) + 6)):
                want[c, o, p] = "target" if p // 4 == o else "context_only"
    assert got == want


def test_merge_refuses_copies_and_gaps(spark):
    a = spark.createDataFrame([("x", "t")], "id string, text string")
    assert M.merge({"a": a, "b": a.withColumn("id", F.lit("y"))}, ["text"], ["id"]).count() == 2
    with pytest.raises(ValueError, match="duplicate id: x in a, b"):
        M.merge({"a": a, "b": a}, ["text"], ["id"])
    with pytest.raises(PySparkException, match="missing text"):
        M.merge({"a": a.withColumn("text", F.lit(""))}, ["text"], []).collect()
    with pytest.raises(ValueError):
        M.merge({}, [], [])


def test_replacement_happens_once(spark):
    df = spark.createDataFrame([("old", "new", True, None), ("old", "", True, None), ("new", "newer", True, "old")], "text string, t string, ok boolean, kept string")
    made = M.replace_text(F.col("text"), F.col("t"), F.col("ok"), F.array(F.lit("x")), F.col("kept"))
    got = [tuple(r) for r in df.select(made["text"], made["text_before_asr"], made["review_reasons"]).collect()]
    assert got == [("new", "old", ["x"]), ("old", None, ["x", "aw_transcript_unusable"]), ("newer", "old", ["x"])]


def test_shards_and_order(spark):
    assert M.shard_bounds(10, 4) == [(0, 3), (3, 3), (6, 3), (9, 1)] and M.shard_bounds(3, 5) == [(0, 1), (1, 1), (2, 1), (3, 0), (3, 0)]
    ids = spark.createDataFrame([("a", 0), ("b", 1)], "id string, pos int")
    shards = spark.createDataFrame([("b", 5, 0), ("a", 6, 1), ("a", 7, 2), ("z", 9, 3)], "id string, v int, seq int")
    assert [(r.id, r.v) for r in M.restore_order(ids, shards, "id", "pos").collect()] == [("a", 7), ("b", 5)]
    with pytest.raises(PySparkException, match="missing id"):
        M.restore_order(ids, shards.where("id = 'a'"), "id", "pos").collect()


def test_splits_are_exact(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, F.lit("big")).otherwise(F.col("id").cast("string")).alias("g"))
    assert {r.part: r["count"] for r in S.row_split(df, "id", 0.1, 1).groupBy("part").count().collect()} == {"valid": 100, "train": 900}
    for seed, ratio in ((3, 0.05), (4, 0.3), (5, 0.7)):
        made = S.group_split(df, "id", "g", ratio, seed)
        sizes = {r["__g"]: r["n"] for r in df.withColumn("__g", F.concat(F.lit("g"), "g")).groupBy("__g").agg(F.count("*").alias("n")).collect()}
        chosen, total, target = set(), 0, int(1000 * ratio)
        for g in sorted(sizes, key=lambda g: hashlib.md5(f"{seed}:{g}".encode()).hexdigest()):
            if total < target and total + sizes[g] <= 999:
                chosen.add(g[1:])
                total += sizes[g]
        assert {r.g for r in made.where("part = 'valid'").select("g").distinct().collect()} == chosen
    parts = S.group_split(df, "id", "g", 0.05, 3)
    assert parts.groupBy("g").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0
    assert parts.where("part = 'train'").count() > 0
    drawn = S.balanced(df.withColumn("c", F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 50 == 1, "y")), "id", "c", 1)
    assert len({r["count"] for r in drawn.groupBy("c").count().collect()}) == 1
    places = sorted(r.pos for r in S.shuffled(df, "id", 4).collect())
    assert places == list(range(1000))


def test_best_n_keeps_the_older_on_ties(spark):
    df = spark.createDataFrame([("k", 1, 0.5, 1), ("k", 2, 0.5, 2), ("k", 3, 0.4, 3), ("k", 3, 0.9, 4)], "k string, step int, loss double, w int")
    assert [r.step for r in K.keep_best(df, ["k"], "loss", "step", 2, "w").orderBy("place").collect()] == [1, 2]


def test_stage_runner(tmp_path):
    from loomspark.plans.runner import Stage

    runs = []
    runner = StageRunner(str(tmp_path / "state.json"), ["a", "b"])
    assert runner.run("a", fingerprint(1), lambda: True, lambda: runs.append(1)) == "complete"
    assert StageRunner(str(tmp_path / "state.json"), ["a", "b"]).run("a", fingerprint(1), lambda: True, lambda: runs.append(1)) == "skipped"
    assert runner.run("a", fingerprint(2), lambda: True, lambda: runs.append(1)) == "complete"
    with pytest.raises(ZeroDivisionError):
        runner.run("b", "x", lambda: True, lambda: 1 / 0)
    assert runner.state["stages"]["b"]["status"] == "failed" and len(runs) == 2
    with pytest.raises(RuntimeError, match="no outputs"):
        runner.run("b", "y", lambda: False, lambda: runs.append(2))
    with pytest.raises(KeyboardInterrupt):
        runner.run("b", "z", lambda: True, lambda: (_ for _ in ()).throw(KeyboardInterrupt()))
    assert StageRunner(str(tmp_path / "state.json"), ["a", "b"]).state["stages"]["b"]["status"] == "failed"
    stages = [Stage("a", lambda: "s", lambda: True, lambda: None), Stage("b", lambda: "s", lambda: True, lambda: None, lambda: ["there.json"])]
    with pytest.raises(FileNotFoundError, match="there.json"):
        runner.run_all(stages, "b")
    assert runner.run_all(stages, "a", "a") == {"a": "complete"}
    with pytest.raises(ValueError):
        StageRunner(str(tmp_path / "state.json"), ["a"], force={"q"})
    (tmp_path / "state.json").write_text("{")
    assert StageRunner(str(tmp_path / "state.json"), ["a"]).state["stages"] == {}


def test_cached_transform_isolates_errors(spark):
    def work(items):
        if "bad" in items:
            raise ValueError("no")
        return [t.upper() for t in items]

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "b", "bad", "c"])], "i int, t string")
    empty = spark.createDataFrame([], "i int, fingerprint string, status string, result string")
    first = cached_transform(rows, empty, "i", "t", work)
    got = {r.i: (r.status, r.result) for r in first.collect()}
    assert got == {0: ("ok", "A"), 1: ("ok", "B"), 2: ("error", "no"), 3: ("ok", "C")}
    again = cached_transform(rows, spark.createDataFrame(first.collect(), first.schema).drop("cached"), "i", "t", work)
    assert {r.i for r in again.collect() if r.cached} == {0, 1, 3}
    with pytest.raises(ValueError):
        same_rows(rows, rows.limit(1))
    assert table_fingerprint(rows) == table_fingerprint(rows.orderBy(F.desc("i")))


def test_sources_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "id string, note string, n int")
    writers.write_manifest(rows, f"{tmp_path}/m")
    assert readers.read_manifest(spark, f"{tmp_path}/m", "id string, note string, n int").count() == 2
    assert spark.read.text(f"{tmp_path}/m").where("value like '%note%'").count() == 1
    receipt = [writers.publish(rows, f"{tmp_path}/p", 2, keep=2) for _ in range(3)][-1]
    assert receipt["rows"] == 2 and writers.current(spark, f"{tmp_path}/p") == receipt["version"] and receipt["previous"]
    with pytest.raises(ValueError):
        writers.publish(rows, f"{tmp_path}/p", 3)
    assert readers.parse_data_files("train=a.json,test=b.json") == {"train": "a.json", "test": "b.json"}
    assert readers.parse_data_files('["a", "b"]') == ["a", "b"] and readers.parse_data_files("a,b") == ["a", "b"]
    assert readers.parse_data_files("train=a.json,b.json") == {"train": ["a.json", "b.json"]}
    assert readers.parse_data_files(["train=a, b", "test=c", "train=d"]) == {"train": ["a", "b", "d"], "test": "c"} and readers.parse_data_files(["a", "b"]) == ["a", "b"]
    assert readers.parse_data_files(" ") is None and readers.parse_data_files([]) is None
    for bad in ("a,x=b", ["x=a", "b"], "=a", "x="):
        with pytest.raises(ValueError):
            readers.parse_data_files(bad)
    deep = spark.createDataFrame([((1,), 2)], "a struct<b int>, `a.b` int")
    assert deep.select(readers.nested(deep, "a.b").alias("x")).first().x == 2
    assert deep.drop("`a.b`").select(readers.nested(deep.select("a"), "a.b").alias("x")).first().x == 1
    (tmp_path / "files" / "sub").mkdir(parents=True)
    for name in ("B.wav", "a.FLAC", "c.txt", "sub/d.mp3"):
        (tmp_path / "files" / name).write_bytes(b"1")
    found = readers.discover(spark, f"{tmp_path}/files", exclude=["sub"]).orderBy("sort_key")
    assert [r.relative_path for r in found.collect()] == ["a.FLAC", "B.wav"]


def test_manifest_index(spark):
    rows = [("1", "t", "p", ["", " "], "7"), ("2", "t", "p", ["c"], "x"), ("3", "t", "", ["c"], "1"), ("4", "t", "p", None, "-5")]
    index = readers.manifest_index(spark.createDataFrame(rows, "id string, text string, latent_path string, caption array<string>, num_frames string"))
    assert [(r.id, r.has_caption, r.num_frames) for r in index.orderBy("id").collect()] == [("1", False, 7), ("2", True, -1), ("4", False, -1)]


def test_streaming_sessions(spark, tmp_path):
    from loomspark.streaming.sessions import gap_sessions, packed

    times = [("u", "2024-01-01 00:00:00", 10.0), ("u", "2024-01-01 00:00:12", 10.0), ("u", "2024-01-01 01:00:00", 5.0), ("u", "2024-01-02 00:00:00", 1.0)]
    spark.createDataFrame(times, "k string, t string, seconds double").select("k", F.col("t").cast("timestamp").alias("ts"), "seconds").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, ts timestamp, seconds double").parquet(f"{tmp_path}/in")
    for name, df in (("gap", gap_sessions(stream, "k", "1 minute", "1 second")), ("packed", packed(stream, "k", 60, 5, "1 second"))):
        query = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        assert query.awaitTermination(120)
    assert spark.table("gap").where("parts = 2").count() == 1
    assert [(r.parts) for r in spark.table("packed").orderBy("start").collect()][:2] == [2, 1]


@pytest.mark.parametrize("seed", range(3))
def test_collapsed_peaks_are_the_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(1, i, float(rng.randint(0, 4))) for i in sorted(rng.sample(range(200), 70))]
    kept = []
    for _, i, v in rows:
        if not kept or i - kept[-1][0] > 4:
            kept.append((i, v))
        elif v > kept[-1][1] + 1e-9:
            kept[-1] = (i, v)
    got = V.collapsed_peaks(spark.createDataFrame(rows, "k int, idx int, value double"), ["k"], 4)
    assert sorted((r.idx, r.value) for r in got.collect()) == kept


def test_schedules(spark):
    from loomspark.functions import schedules as C

    assert C.ranked_path("a/b.jsonl", 3, 4) == "a/b.rank03.jsonl" and C.ranked_path("a/b", 0, 200) == "a/b.rank000" and C.ranked_path("x", 0, 1) == "x"
    one = lambda *flags: spark.range(1).select(C.guidance(F.lit(1.0), F.lit(1.0), F.lit(5.0), F.lit(None).cast("double"), *map(F.lit, flags)).alias("s")).first().s
    assert tuple(one(True, False, True)) == (1.0, 1.0, 0.0, True) and tuple(one(True, True, False)) == (1.0, 1.0, 5.0, False)
    with pytest.raises(Exception, match="equal scales"):
        one(True, True, True)
    assert C.batches_per_epoch(10, 3, 2, True) == 1 and C.batches_per_epoch(10, 3, 2, False) == 2
    df = spark.createDataFrame([(0, [" a ", ""]), (1, None), (2, ["x", "y"])], "i int, c array<string>")
    got = {r.i: r.p for r in df.select("i", C.pick_caption(F.col("c"), F.col("i"), 1).alias("p")).collect()}
    assert got[0] == "a" and got[1] is None and got[2] in ("x", "y")
    times = [r.t for r in spark.range(64).select(C.stratified_time(F.col("id"), F.lit(0.5), 64).alias("t")).collect()]
    assert times == sorted(times) and abs(sum(times) / 64 - 0.5) < 1e-6


def test_failed_batches_block_publishing(spark):
    from loomspark.operators.transcripts import finite, refuse_failures

    batches = spark.createDataFrame([("ok",), ("failed",)], "status string")
    refuse_failures(batches, allow=True)
    with pytest.raises(ValueError):
        refuse_failures(batches)
    df = spark.createDataFrame([("1.5",), ("nan",), ("x",), (None,), ("inf",)], "v string")
    assert [r[0] for r in df.select(finite(F.col("v"), F.lit(-1.0))).collect()] == [1.5, -1.0, -1.0, -1.0, -1.0]


def test_unsafe_proposals_are_rejected(spark):
    from loomspark.operators.transcripts import change_log, resolve

    before = "the quick brown fox jumps"
    after = {"near": "the quick brown fox jumped", "unrelated": "zzzzz yyyy xxxx wwww vvvv", "marks": "!?!?!?!?!?!?!?!?!?!?!?!?!", "marked": "the quick brown fox jumps!", "short": "the"}
    rows = spark.createDataFrame([(k, "speech", "u", 0.0, 1.0, before) for k in after] + [("silent", "speech", "u", 0.0, 1.0, "...")], "id string, kind string, source_uid string, start double, end double, text string")
    made = spark.createDataFrame([(k, v, "corrected", "speech") for k, v in after.items()] + [("silent", "abc", "corrected", "speech")], "id string, corrected_text string, status string, category string")
    got = resolve(rows, made)
    assert {r.id: r.outcome for r in got.collect()} == {k: "accepted" if k in ("near", "marked") else "rejected_unsafe" for k in [*after, "silent"]}
    log = {r.id: r for r in change_log(got).collect()}  # rejected proposals are logged with what was suggested, their text unchanged
    assert set(log) == {*after, "silent"} and {k for k, r in log.items() if r.after != r.before} == {"near", "marked"}
    assert log["unrelated"].suggested == after["unrelated"] and log["unrelated"].similarity < 0.6 and log["marked"].similarity == 1.0


def test_settings(tmp_path):
    from loomspark.plans.settings import batch_columns, given, overridden, read_settings

    (tmp_path / "s.json").write_text('{"longest": 4.0, "shortest": 1.0}')
    (tmp_path / "l.json").write_text("[1]")
    limits = overridden(W.Limits(), read_settings(f"{tmp_path}/s.json"), "limits")
    assert (limits.longest, limits.shortest, limits.hop) == (4.0, 1.0, W.Limits().hop) and overridden(limits, None, "x") == limits
    assert overridden(limits, given(hop=0.02, pause=None), "x").hop == 0.02
    for bad in ({"nothing": 1}, {"longest": 1.0}, [1]):
        with pytest.raises(ValueError):
            overridden(limits, bad, "limits")
    with pytest.raises(ValueError):
        read_settings(f"{tmp_path}/l.json")
    assert batch_columns(latent=False) == ("text_ids", "text_mask", "num_frames") and batch_columns(duration=True)[-1] == "duration_features"


def test_saved_index_is_made_again_when_it_must(spark, tmp_path):
    schema = "id string, text string, latent_path string, num_frames string"
    path, cache = f"{tmp_path}/m.jsonl", f"{tmp_path}/cache"
    write = lambda n: (tmp_path / "m.jsonl").write_text("".join(f'{{"id":"{i}","text":"t","latent_path":"p","num_frames":"{i}"}}\n' for i in range(n)))
    stamp = lambda: spark.read.json(f"{cache}/about").first()["stamp"]
    write(3)
    assert readers.saved_index(spark, path, schema, cache).count() == 3
    first = stamp()
    assert readers.saved_index(spark, path, schema, cache).count() == 3 and stamp() == first
    write(5)
    assert readers.saved_index(spark, path, schema, cache).count() == 5 and stamp() != first
    again = stamp()
    assert readers.saved_index(spark, path, schema, cache, caption="other").count() == 5 and stamp() != again
    rows = spark.range(6).withColumnRenamed("id", "idx")
    assert sorted(r.idx for r in readers.rows_at(rows, spark.createDataFrame([(2,), (2,), (9,)], "idx long")).collect()) == [2, 2]
    assert readers.skipped_first(rows, 4).count() == 2 and readers.skipped_first(rows, 0, native_shards=True, world=2).count() == 6
    with pytest.raises(ValueError):
        readers.skipped_first(rows, 1, native_shards=True, world=2)


def test_metrics_are_appended_as_rows(spark, tmp_path):
    for step in (1, 2):
        writers.append_metrics(spark.createDataFrame([(step, 0.5, None, "x")], "step int, loss double, lr double, note string"), f"{tmp_path}/m")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/m").collect()) == [(1, "loss", 0.5), (2, "loss", 0.5)]


def test_agents_answer_in_order_of_preference(spark):
    from loomspark.operators.transcripts import answered, corrected_rows

    def picky(text):
        if text != "a":
            raise ValueError("no")
        return "picky " + text

    def broken_on_c(text):
        if text == "c":
            raise ValueError("never")
        return "plain " + text

    batches = spark.createDataFrame([("u", i, t) for i, t in enumerate("abc")], "source_uid string, ordinal int, payload string")
    got = {r.ordinal: (r.status, r.agent, r.attempt, r.result, r.error) for r in answered(batches, [("picky", picky), ("plain", broken_on_c)]).collect()}
    assert got[0] == ("ok", "picky", 1, "picky a", None) and got[1] == ("ok", "plain", 1, "plain b", None) and got[2] == ("failed", None, 4, None, "plain: never")
    clips = spark.createDataFrame([("x", "old", "train", ["a"]), ("y", "", "train", None)], "id string, text string, status string, review_reasons array<string>")
    done = spark.createDataFrame([("x", "speech", "old", "new", "other", True, "accepted")], "id string, kind string, text string, final_text string, category string, force_review boolean, outcome string")
    rows = {r.id: r for r in corrected_rows(clips, done).collect()}
    assert (rows["x"].text, rows["x"].asr_text_raw, rows["x"].status, rows["x"].review_reasons) == ("new", "old", "review", ["a", "llm_category_other"])
    assert (rows["y"].text, rows["y"].status, rows["y"].review_reasons, rows["y"].correction) == ("", "train", None, None)
