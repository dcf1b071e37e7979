"""Search, sharding, toxicity, SimHash groups, line dedup, pipeline: against brute force and awkward tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomspark.llm import ann, line_dedup, sharding, simhash, toxicity
from loomspark.llm.components import connected_components
from loomspark.llm.queries import QUERIES
from tests.llm.helpers import rough


def nearest(ids, x, query, k):
    score = x @ x[ids.index(query)]
    order = sorted((i for i in range(len(ids)) if ids[i] != query), key=lambda i: (-score[i], ids[i]))
    return [(ids[i], score[i]) for i in order[:k]]


def test_search_recall_and_order(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float)
    got = {}
    for r in QUERIES["op1_ann"](spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in ids if i % 20 == 0}
    share = []
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
        want = nearest(ids, x, q, 20)
        share.append(len({f[1] for f in found} & {w[0] for w in want}) / 20)
        exact = dict(zip(ids, x @ x[ids.index(q)]))
        assert all(abs(exact[v] - s) < 1e-9 for _, v, s in found)
    assert np.mean(share) >= 0.9


def test_search_with_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    same = rng.normal(size=4).astype("float32").tolist()
    rows = [(i, same) for i in range(60)] + [(100 + i, rng.normal(size=4).astype("float32").tolist()) for i in range(40)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [1.0]), (0, same)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, q string")
    found = ann.search(df, df.where("vec_id % 20 = 0"), k=20, target=1.0, deviations=9.0, sample_rows=16)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    usable = [(i, v) for i, v in dict(rows[:100]).items()]
    ids, x = [i for i, _ in usable], np.array([v for _, v in usable], dtype=float)
    assert set(got) == {0, 20, 40, 100, 120}
    for q in got:  # all are tried, so the probed lists hold every neighbour
        assert [got[q][r] for r in range(1, 21)] == [w[0] for w in nearest(ids, x, q, 20)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
    few = ann.search(df.where("vec_id in (0, 1, 100)"), df.where("vec_id = 0"), k=20)
    assert sorted(r.vec_id for r in few.collect()) == [1, 100]


@pytest.mark.parametrize("kind", ["even", "clustered", "hot"])
def test_search_recall_from_lists_alone(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    if kind == "clustered":
        x = x * 0.2 + rng.normal(size=(30, 24))[rng.integers(30, size=3000)]
    if kind == "hot":
        x[: 3000 // 3] = x[0]
    x = x.astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, df.where("vec_id % 20 = 0"), sample_rows=256).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20)) and all(len(f) == 20 for f in got.values())
    x, share = x.astype(float), []
    for q, found in got.items():
        score = x @ x[q]
        assert all(abs(score[v] - s) < 1e-6 for _, v, s in found) and q not in {v for _, v, _ in found}
        want = [i for i in np.lexsort((np.arange(3000), -score)) if i != q][:20]
        share.append(len({v for _, v, _ in found} & set(want)) / 20)
    assert np.mean(share) >= 0.9


def test_blocks_without_probed_entries_are_empty(spark):
    """A block can meet queries of which none probes its entries."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 8)).astype("float32")
    index = ann.fit(x, 4, 2)
    cells = index.cells(x)
    found = ann.best_of(index, x[:3], x, cells, index.codes(x, cells), np.zeros(40), np.arange(40), np.zeros((3, 4), dtype=bool), 5, 2.0)
    assert [len(part) for part in found] == [0, 0, 0]


def least_capacity(sizes, shards):
    def need(c):
        used, room = 1, c
        for s in sizes:
            if s > room:
                used, room = used + 1, c
            room -= s
        return used

    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if need(mid) <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("seed", range(5))
def test_capacity_is_the_smallest(spark, seed):
    rng = random.Random(seed)
    n, shards = rng.choice([1, 7, 300, 2000]), rng.choice([2, 7, 40])
    ids = sorted(rng.sample(range(-(10 ** rng.choice([4, 17])), 10**12), n))
    sizes = [rng.choice([1, 2, 900]) * rng.randint(1, 50) for _ in ids]
    groups = spark.createDataFrame(list(zip(ids, sizes)), "gid long, size long")
    capacity, cuts = sharding.cut_points(groups, shards, first_parts=rng.choice([4, 64]), parts=rng.choice([2, 16]))
    assert capacity == least_capacity(sizes, shards) and len(cuts) < shards
    load, at = [0] * shards, 0
    for i, s in zip(ids, sizes):
        at = sum(i >= c for c in cuts)
        load[at] += s
    assert max(load) <= capacity


def test_shards_of_documents(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_sharding"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    slots, of_text, load = {}, {}, {}
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert r.size == len(data) + 16 and r.text_crc32 == zlib.crc32(data)
        assert of_text.setdefault(docs[r.doc_id], r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))
    groups = {}
    for i, t in sorted(docs.items()):
        groups.setdefault(t, [i, 0])[1] += len((t or "").encode()) + 16
    assert max(load.values()) <= least_capacity([s for _, s in sorted(groups.values())], 40)


def test_shards_of_awkward_rows(spark):
    rows = sharding.contiguous_shards(rough(spark), 3).collect()
    assert len(rows) == 8 and len({r.shard for r in rows if r.doc_id in (0, 4)}) == 1
    assert next(r.text_crc32 for r in rows if r.doc_id == 1) == 0  # no text, no bytes
    assert sharding.contiguous_shards(rough(spark, 0), 3).count() == 0


def test_shards_count_rows_without_ids(spark):
    rng = random.Random(2)
    data = [(None if i % 3 == 0 else i, f"text {i % 400} " + "x" * rng.randrange(60)) for i in range(900)] + [(None, "a copy")] * 300
    rows = sharding.contiguous_shards(spark.createDataFrame(data, "doc_id long, text string"), 10).collect()
    assert len(rows) == 1200 and sum(r.size for r in rows) == sum(len(t) + 16 for _, t in data)
    load, slots = {}, {}
    for r in rows:
        load[r.shard] = load.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for r in rows:
        groups.setdefault(r.group_id, [r.shard, 0])[1] += r.size
    assert max(load.values()) == least_capacity([s for _, (_, s) in sorted(groups.items())], 10) and len({r.shard for r in rows if r.size == 22}) == 1


def prints(text):
    import re

    from xxhash import xxh64_intdigest

    words = re.findall(rb"[^\x20\x09-\x0d]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_simhash_groups_are_the_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = {i: prints(t) for i, t in docs.items()}
    ids = sorted(docs)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if bin(want[a] ^ want[b]).count("1") <= 2]
    root = components(ids, linked)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{want[i]:016x}", root[i]) for i in ids}


def test_simhash_links_at_two_bits_across_chains(spark):
    rng = random.Random(5)
    prints_ = [rng.getrandbits(64) for _ in range(20)]
    for _ in range(150):
        p = rng.choice(prints_)
        for b in rng.sample(range(64), rng.choice([1, 2, 3])):
            p ^= 1 << b
        prints_.append(p)
    prints_ = sorted(set(prints_))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints_}
    links = simhash.link_fingerprints(spark.createDataFrame([(s,) for s in signed.values()], "fp long"))
    got = {r.node: r.root for r in connected_components(links).collect()}
    want = components(sorted(signed.values()), [(signed[a], signed[b]) for a in prints_ for b in prints_ if a < b and bin(a ^ b).count("1") <= 2])
    assert {n: got.get(n, n) for n in want} == want


def test_simhash_awkward_rows(spark):
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(rough(spark)).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 3, 4: 0, 5: 1, 6: 6}
    kept = simhash.keep_one(rough(spark))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 3, 6] and kept.columns == rough(spark).columns
    assert simhash.near_duplicates(rough(spark, 0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = sorted({n for a, b in links if a != b for n in (a, b)})
    assert got == components(nodes, [(a, b) for a, b in links if a != b])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def cleaned(rows, min_sites=5):
    """Brute force: (id, text, removed) of (id, text, site) rows."""
    sites, owner = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            key = line.strip(line_dedup.BLANKS)
            if key:
                sites.setdefault(key, set()).add(site or "")
                known = owner.get(key)
                owner[key] = known if i is None else i if known is None else min(i, known)
    out = []
    for i, text, _ in rows:
        kept, seen = [], set()
        for line in (text or "").split("\n"):
            key = line.strip(line_dedup.BLANKS)
            if key and len(sites[key]) >= min_sites:
                if owner[key] != i or key in seen:
                    continue
                seen.add(key)
            kept.append(line)
        out.append((i, text if text is None else "\n".join(kept), 0 if text is None else text.count("\n") + 1 - len(kept)))
    return sorted(out, key=repr)


def test_lines_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(((r.doc_id, r.text, r.removed_lines) for r in line_dedup.drop_spread_lines(docs).collect()), key=repr)
    assert got == cleaned([(r.doc_id, r.text, r.source) for r in docs.collect()]) and sum(r[2] for r in got) > 0
    out = line_dedup.drop_spread_lines(rough(spark))
    assert sorted(out.columns) == sorted(rough(spark).columns) and out.count() == 8
    assert line_dedup.drop_spread_lines(rough(spark, 0)).count() == 0


def test_lines_of_large_null_and_repeated_ids(spark):
    big = 2**60
    rows = [(big + i, "shared by large ids\nown %d\n\n shared by large ids\r" % i, f"s{i % 7}") for i in range(9)]
    rows += [(None, "only without ids\nshared by large ids\nonly without ids", f"s{i % 7}") for i in range(9)]
    rows += [(big + 2, "another text of the id\nshared by large ids", "s1"), (big, "shared by large ids\nshared by large ids", None)] * 2
    rows += [(big + 20, None, "s2"), (big + 21, "", "s3"), (None, None, None)]
    rows += [(5 - i, "\n".join(["an owned line"] * (i + 1)), f"s{i}") for i in range(6)]
    random.Random(3).shuffle(rows)
    got = [(r.doc_id, r.text, r.removed_lines) for r in line_dedup.drop_spread_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()]
    assert sorted(got, key=repr) == cleaned(rows)
    assert (None, "only without ids", 2) in got and (0, "an owned line", 5) in got and (5, "", 1) in got


@pytest.mark.parametrize("sites", [1, 3, 4, 5, 6, 7, 40])
def test_near_the_bound_spread_is_exact(spark, sites):
    rows = [(1, 2, f"s{i % sites}", i) for i in range(200)] + [(3, 4, "s0", 1)]
    found = line_dedup.spread_lines(spark.createDataFrame(rows, "k1 long, k2 long, site string, id long"), 5).collect()
    assert [(r.k1, r.owner) for r in found] == ([(1, 0)] if sites >= 5 else [])


def test_toxicity_on_planted_insults(spark):
    rng = random.Random(1)
    syllables = "an er in on th re st le ou en ti ha".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(2, 4)))
    insults = ["stupid", "moron", "idiot", "scum"]
    texts = []
    for i in range(600):
        words, bad = [word() for _ in range(rng.randint(5, 60))], i % 4 == 0
        for _ in range(2 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        texts.append((i, " ".join(words), int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    rows = toxicity.score(docs, model).join(docs.select("doc_id", "toxic", toxicity.held_out(F.col("doc_id")).alias("h")), "doc_id").where("h").collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = sum((r.score >= 0.7) == bool(r.toxic) for r in rows)
    assert right >= 0.97 * len(rows)
    margin = dict(zip(forms := ["st-upid", "stuupid", "m.o.r.o.n", "idioot", "therein", "station"], model.margins(forms)))
    assert min(margin[w] for w in forms[:4]) > max(margin[w] for w in forms[4:])
    assert "moron" in toxicity.words_of("you, m o r o n")
    got = {r.doc_id: r.score for r in toxicity.score(rough(spark), model).collect()}
    assert got[1] == got[2] and all(0 <= s <= 1 for s in got.values())
    assert toxicity.score(rough(spark, 0), model).count() == 0 and toxicity.keep_clean(rough(spark), model).count() == 8
    nothing = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic").limit(0))
    assert {r.score for r in toxicity.score(rough(spark), nothing).collect()} == {0.0}


def test_kernel_is_the_sum_over_common_gapped_subsequences():
    """Plain definition: subsequences of 3 within 5 characters, and of 5 and 7 with one skipped at most, weighted by decay.
    A word's length counts each occurrence apart."""
    words = ["moron", "m.o.r.o.n", "mooron", "stupidity", "stupid", "привет", "превед", "réeuxen", "xy", "abcdefghijklmnopqrst"]

    def weights(word):
        out, text, square = {}, "^" + word, 0.0
        for places, weight in toxicity.STEPS:
            for at in range(len(text) - places[-1]):
                key = (text[at], *(text[at + p] for p in places))
                out[key] = out.get(key, 0.0) + weight
                square += weight * weight
        return out, np.sqrt(square) or 1.0

    plain, norm = zip(*map(weights, words))
    dot = lambda a, b: sum(x * b.get(k, 0.0) for k, x in a.items())
    ids, owner = toxicity._ids(words)
    assert owner.tolist() == list(range(len(words)))
    used, base = toxicity.landmarks_of(ids)
    got = toxicity.kernel(ids, used, base)
    for i, a in enumerate(plain):
        for j, b in enumerate(plain):
            assert abs(got[i, j] - dot(a, b) / norm[i] / norm[j]) < 0.02, (words[i], words[j])
    assert got[0, 2] > 0.4 > got[0, 3] and got[5, 6] > 0.1


def test_pipeline_keeps_one_of_each_group_of_near_copies(spark, sf_dir):
    rng = random.Random(4)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(6, 120))]
        for edits in (0, 0, 1, 1, 2, 3, 5):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += ["", None, "one", "ONE", "one two three"]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))
    assert len(set(root)) < simhash.keep_one(docs).count()
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), sf_dir).count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    state, ids = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, sf_dir)
        rows = state.collect()
        assert name == corpus_pipeline.STAGES[-1][0] or sorted(state.columns) == sorted(docs.columns)
        state = spark.createDataFrame(rows, state.schema)
        ids.append(len(rows))
    assert ids[0] >= ids[1] == ids[2] > ids[3] >= ids[4] == ids[5]
    assert state.where("not round_trip").count() == 0
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(r.doc_id for r in rows)


def test_pipeline_of_awkward_documents(spark, sf_dir, tmp_path):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rows = [(0, "the quick brown fox jumps over the lazy dog"), (None, "a row without an id"), (None, "a row without an id"), (1, None), (2, ""), (3, "lorem ipsum dolor " * 20_000)]
    rows += [(4, "the quick brown fox jumps over the lazy dog"), (5, "one text"), (5, "one text"), (6, "first text of six"), (6, "second text, of six too"), (7, f"so {item} it is"), (None, item)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 2, 3.0, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, node int, stamp double, __lost string")
    labels, bench = spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{tmp_path}/full/{name}.parquet")
        (df.limit(0) if name != "benchmark" else df).write.parquet(f"{tmp_path}/none/{name}.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted([0, 1, 3, 5, 6, 6, None, None], key=repr)
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got) and next(r for r in got if r.doc_id == 1).n_tokens == 0
    state = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, f"{tmp_path}/full")
        assert sorted(state.columns) == sorted(docs.columns)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_pipeline_stages_are_the_brute_force(spark, sf_dir):
    """Line dedup, decontamination and encoding against plain versions, each on what the stage before kept."""
    from tests.llm.test_simple_operators import leaks

    import sentencepiece

    from loomspark.llm import queries

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect() if scores[r.doc_id] < 0.7 or not r.text)
    lines = corpus_pipeline.drop_spread_lines(spark, kept, sf_dir)
    want = cleaned([(r.doc_id, r.text, r.source) for r in kept.collect()])
    assert sorted(((r.doc_id, r.text) for r in lines.collect()), key=repr) == sorted(((i, t) for i, t, _ in want), key=repr)
    near = corpus_pipeline.drop_near_copies(spark, lines, sf_dir)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in near.collect()]
    leaked = {r[0] for r in leaks(rows, items)}
    clean = corpus_pipeline.drop_leaks(spark, near, sf_dir)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in rows if i not in leaked)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    texts = dict(rows)
    assert all(r.ids == library.encode(texts[r.doc_id] or "") and r.round_trip for r in corpus_pipeline.encode(spark, clean, sf_dir).collect())


def test_near_copies_meet_in_simhash_tables(spark, monkeypatch):
    """Fingerprints are as far apart as the sets; tables find all pairs of 0.8; so they do in many groups and without sent fingerprints."""
    from loomspark.llm import near_copies

    rng = random.Random(11)
    texts = []
    for _ in range(30):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((8, 9, 12, 60, 200)))]
        texts += [" ".join(base)] + [" ".join(base[:at] + base[at + cut :]) for at, cut in ((0, 1), (len(base) // 2, 1), (3, 2), (0, len(base) // 9))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in near_copies.shingled(docs, "doc_id", "text", 5, "bits").collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in map(str.split, texts)]
    differ = lambda a, b: sum((x ^ y & (1 << 64) - 1 if y < 0 <= x else x ^ y).__and__((1 << 64) - 1).bit_count() for x, y in zip(found[a].bits, found[b].bits)) / 36 / 64
    near = []
    for i in range(len(texts)):
        for j in range(i):
            both, total = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both >= 0.8 * total and sets[i] != sets[j]:
                near.append(tuple(sorted((found[i].node, found[j].node))))
            if min(len(sets[i]), len(sets[j])) > 50 and (both or j == i - 1):
                assert abs(differ(i, j) - np.arccos(both / np.sqrt(len(sets[i]) * len(sets[j]))) / np.pi) < 0.06
    assert len(near) > 30
    nodes = spark.createDataFrame([(n, s, 1, b) for n, s, b in {(r.node, r.size, tuple(r.bits)) for r in found.values()}], "node long, size int, copies long, bits array<long>")
    pairs = {(r.a, r.b) for r in near_copies.met(near_copies.dealt(nodes, 1, False), False, 3).collect()}
    assert all((a, b) in pairs or {(a, a), (b, b)} <= pairs for a, b in near)
    apart = near_copies.met(near_copies.dealt(nodes.withColumn("root", F.col("node")), 0, True), True, 3)
    assert set(near) <= {(r.a, r.b) for r in apart.collect()}
    classes = lambda: sorted((r.doc_id, r.component_id) for r in near_copies.near_copies(docs).collect())
    want = classes()
    monkeypatch.setattr(near_copies, "GROUP_NODES", 16)
    monkeypatch.setattr(near_copies, "BROADCAST_BYTES", 0)
    assert classes() == want
