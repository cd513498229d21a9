"""Operators on whole tables: mixing, packing, near-duplicates of texts and vectors, nearest neighbours, the pipeline."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import graph, lattice, mixing, neighbours, packing, pii, queries, simhash, toxicity
from tallymark.llm.frames import importable


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def grouped(ids, pairs):
    """Smallest reachable id of each."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


# --- mixing ---------------------------------------------------------------------------------------------------------

SIZES = {"a": 1000, "b": 300, "c": 37, "d": 3, None: 60}
WEIGHTS = {"a": 5, "b": 3, "c": 2}


def sources(spark):
    rows = [(i, s) for s, n in SIZES.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string").withColumns({"block": F.lit(1), "KEY": F.lit("k")})


def test_every_source_keeps_its_share_to_within_a_block(spark):
    names = {"block": "b"}
    out = mixing.mix(sources(spark), WEIGHTS, default_weight=1, block_rows=4, names=names)
    assert out.columns == ["doc_id", "source", "block", "KEY", "b", "slot", "release", "deadline", "place"]
    rows = out.collect()
    assert Counter(r.source for r in rows) == SIZES
    of_slot = defaultdict(list)
    for r in rows:
        of_slot[r.slot].append(r)
        assert r.release <= r.slot < r.deadline
    assert sorted(of_slot) == list(range(len(of_slot)))
    assert all(len({(r.source, r.b) for r in s}) == 1 and sorted(r.place for r in s) == list(range(len(s))) for s in of_slot.values())
    order = [of_slot[t][0].source for t in range(len(of_slot))]
    # while no source has run out, the share of each is within one block at every slot
    weights = {**WEIGHTS, "d": 1, None: 1}
    seen = Counter()
    for t in range(sum(weights.values())):
        seen[order[t]] += 1
        assert all(abs(seen[s] - (t + 1) * w / 12) < 1 for s, w in weights.items())


def test_mixing_edge_cases(spark):
    docs = sources(spark).drop("block")
    assert mixing.mix(docs.limit(0), WEIGHTS, default_weight=1, block_rows=4).count() == 0
    same = spark.createDataFrame([(None, None)] * 9 + [(1, "x")] * 5, "doc_id long, source string")
    out = mixing.mix(same, {}, default_weight=2, block_rows=2).collect()
    assert len(out) == 14 and len({(r.slot, r.place) for r in out}) == 14
    with pytest.raises(ValueError, match="already"):
        mixing.mix(sources(spark), WEIGHTS, default_weight=1, block_rows=4)
    with pytest.raises(ValueError, match="whole numbers"):
        mixing.mix(docs, {"a": 0}, default_weight=1, block_rows=4)


def test_mixing_runs_no_python(spark):
    plan = mixing.mix(sources(spark), WEIGHTS, default_weight=1, block_rows=4, names={"block": "b"})
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


# --- packing --------------------------------------------------------------------------------------------------------


def test_ids_of_words_equal_the_library():
    words = packing.WordIds(queries.vocabulary("word_bpe_49k.json"), max_words=100)
    letters = [*map(chr, range(0x20, 0x180)), *map(chr, range(0x2010, 0x2060)), "\x1c", "\x85", "中", "é", "<|endoftext|>"]
    letters += ["'s", "'re", "'LL", "ß", " ", "the", "ing"] * 20
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        assert words(text) == words.whole(text), text


def cost(at, penalty, cuts, length):
    total = 0
    for i, j in zip(cuts, cuts[1:], strict=False):
        size = at[j] - at[i]
        assert 0 < size <= length
        padded = size if size & (size - 1) == 0 and 4 * size >= length else length
        total += padded - size + penalty[j]
    return total


def test_windows_are_the_best_ones():
    rng = random.Random(9)
    for _ in range(200):
        at = [0]
        while len(at) < rng.randint(2, 14):
            at.append(at[-1] + rng.randint(1, 9))
        penalty = [0, *(rng.choice((0, 2, 5)) for _ in at[1:])]
        best = [0] + [10**9] * (len(at) - 1)
        for j in range(1, len(at)):
            for i in range(j):
                if at[j] - at[i] <= 16:
                    best[j] = min(best[j], best[i] + cost(at, penalty, [i, j], 16))
        cuts = packing.best_windows(at, penalty, 16)
        assert cuts[0] == 0 and cuts[-1] == len(at) - 1
        assert cost(at, penalty, cuts, 16) == best[-1]


def check_pieces(pieces, ids, length=4096):
    """Every id of every document lies in exactly one piece, and sequences have no gap."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            values = np.array(ids[doc][p.start : p.start + p.length], "<u4").tobytes()
            assert p.start == at and p.ids_crc32 == zlib.crc32(values) and p.doc_tokens == len(ids[doc])
            at += p.length
        assert at == len(ids[doc])
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= length
    return sum(next(iter(s)).padded for s in by_sequence.values()) / sum(map(len, ids.values()))


def library_ids(spark, table=None):
    words = packing.word_ids(queries.vocabulary("word_bpe_49k.json"))
    docs = table or spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return {r.doc_id: [*np.frombuffer(words.whole(r.text or ""), "<u4").tolist(), 2] for r in docs.collect()}


def test_packing_query(spark):
    pieces = queries.QUERIES["op6_sequence_packing"](spark, SF_DIR).collect()
    assert check_pieces(pieces, library_ids(spark)) < 1.03


def test_packing_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (4, "One. Two! Three?"), (5, "a.b " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "piece": F.lit("old")})
    out = packing.pack(docs, queries.vocabulary("word_bpe_49k.json"), block_tokens=5000)
    assert out.columns == ["doc_id", "row", "piece"]
    pieces = out.select("doc_id", "piece.*").collect()
    check_pieces(pieces, library_ids(spark, docs))
    assert all(zlib.crc32(p.ids) == p.ids_crc32 for p in pieces)
    assert packing.pack(docs.limit(0), queries.vocabulary("word_bpe_49k.json")).count() == 0


# --- near-duplicates of texts ---------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "a", "A b", "a B c", "É é x y", "the quick brown fox jumps " * 9, "a " * 400])
def test_fingerprints(text):
    assert simhash.fingerprint(text) & 2**64 - 1 == plain_fingerprint(text)
    assert simhash.fingerprint(text, step=2) == simhash.fingerprint(text)


def test_the_code_covers_every_word_once():
    homes = simhash.golay_homes()
    assert np.array_equal(np.bincount(homes), np.full(4096, 2048))


def test_copies_reach_the_home_of_every_fingerprint_in_range():
    rng = np.random.default_rng(10)
    prints = rng.integers(-(2**63), 2**63 - 1, 500)
    _, copies = simhash.anchors(prints, 2)
    reached = set(copies.tolist())
    for _ in range(20):
        other = prints ^ (np.int64(1) << rng.integers(0, 64, 500)) ^ (np.int64(1) << rng.integers(0, 64, 500))
        homes, _ = simhash.anchors(other, 0)
        assert all((i << 24) + h in reached for i, h in enumerate(homes.tolist()))


def test_close_pairs_are_all_found_once(spark):
    rng = np.random.default_rng(11)
    prints = rng.integers(-(2**63), 2**63 - 1, 60)
    for _ in range(3):
        prints = np.unique(np.concatenate([prints, prints ^ (np.int64(1) << rng.integers(0, 64, len(prints)))]))
    df = spark.createDataFrame([(int(x),) for x in prints], "simhash long")
    got = [(r.a, r.b) for r in simhash.close_pairs(df).collect()]
    plain = prints.tolist()
    want = {(a, b) for a in plain for b in plain if a < b and ((a ^ b) & 2**64 - 1).bit_count() <= 2}
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(12)
    pairs = [(i, i + 1) for i in range(100, 180)] + [(5, i) for i in range(200, 260)] + [(7, 7), (None, 3), (300, 301), (301, 300)]
    pairs += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(150)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.id: r.component for r in graph.components(df).collect()}
    clean = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    assert got == grouped({x for p in clean for x in p}, clean)
    assert graph.components(df.limit(0)).count() == 0


def test_simhash_query(spark):
    out = queries.QUERIES["op7_simhash"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = grouped(ids, pairs)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {i: (f"{prints[i]:016x}", want[i]) for i in ids}


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "same words here now"), (3, "same words  HERE now"), (3, "same words here now"), (9, None), (8, ""), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "kept_id": F.lit(2)})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 8, None]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_components_that_share_an_id_keep_a_row_each(spark):
    same = " ".join(f"word{i}" for i in range(40))
    rows = [(None, "one of its own"), (None, "quite another text here"), (7, "first text of seven"), (7, "unlike the first at all")]
    rows += [(7, same), (5, same), (5, same), (None, same)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([*rows[:4], (5, same)], key=str)
    other = docs.withColumn("lang", F.lit("x")).union(docs)  # rows that differ in another column only
    assert sorted(((r.doc_id, r.text) for r in simhash.keep_one(other).collect()), key=str) == sorted(kept, key=str)


# --- vectors --------------------------------------------------------------------------------------------------------


def test_lattice_points_are_the_nearest_ones():
    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 8)) * 2
    points = lattice.decode(x)
    assert len(lattice.neighbours()) == 240 and ((lattice.neighbours() ** 2).sum(axis=1) == 8).all()
    own = ((2 * x - points) ** 2).sum(axis=1)
    for n in lattice.neighbours():
        assert (((2 * x - points - n) ** 2).sum(axis=1) >= own - 1e-9).all()


VECTORS = "vec_id long, embedding array<float>, label int, cells int"


def planted(rng, n=300, dims=64):
    base = rng.normal(size=(n, dims))
    near = base[:100] + rng.normal(size=(100, dims)) * 0.25
    crowd = base[:1] + rng.normal(size=(150, dims)) * 0.2
    return np.concatenate([base, near, crowd, base[:20], base[:20]]).astype(np.float32)


@pytest.mark.parametrize("part", [1000, 40])
def test_links_of_vectors_equal_brute_force(spark, part):
    rng = np.random.default_rng(14)
    x = planted(rng)
    label = rng.integers(0, 2, len(x))
    rows = [(i, v.tolist(), int(y), 0) for i, (v, y) in enumerate(zip(x, label, strict=True))]
    n = len(rows)
    bad = [None, [0.0] * 64, [], [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63]
    rows += [(n + i, v, 0, 0) for i, v in enumerate(bad)] + [(n + 6, x[0].tolist(), None, 0), (n + 7, [1.0, 2.0], 0, 0)]
    out = lattice.link(spark.createDataFrame(rows, VECTORS), 0.93, lattice.Settings(part=part)).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    close = (unit @ unit.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(close, False)
    links = {**dict(enumerate(close.sum(axis=1).tolist())), **{n + i: 0 for i in range(8)}}
    want = grouped(range(n + 8), zip(*np.nonzero(np.triu(close)), strict=True))
    got = {r.vec_id: r for r in out}
    assert len(out) == n + 8 and all(r.n_links <= links[r.vec_id] for r in out)
    assert sum(r.n_links for r in out) >= 0.99 * sum(links.values())
    assert np.mean([got[i].component_id == want[i] for i in want]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_links_of_odd_rows(spark):
    same = [(None, [1.0, 0.0], 1, 0), (4, [1.0, 0.0], 1, 0), (2, [2.0, 0.0], 1, 0), (2, [2.0, 0.0], 1, 0)]
    df = spark.createDataFrame(same, VECTORS)
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.link(df, 0.93).collect()]
    assert sorted(got, key=str) == [(2, 3, 2, True), (2, 3, 2, True), (4, 3, 2, False), (None, 3, 2, False)]
    assert lattice.link(df.limit(0), 0.93).count() == 0


@pytest.mark.parametrize("dims", [4, 8, 12, 64])
def test_near_vectors_meet_in_few_dimensions_as_well(dims):
    rng = np.random.default_rng(dims)
    settings = lattice.Settings()
    a = lattice._unit(rng.normal(size=(3000, dims)))
    side = rng.normal(size=a.shape)
    side = lattice._unit(side - (side * a).sum(axis=1)[:, None] * a)
    cosine = rng.uniform(0.93, 0.95, len(a))[:, None]
    ca, cb = (lattice.cells(x, settings) for x in (a, cosine * a + np.sqrt(1 - cosine**2) * side))
    meets = (cb == ca[:, :, :1]).any(axis=2) | (ca == cb[:, :, :1]).any(axis=2)
    assert meets.any(axis=1).mean() >= 0.98


@pytest.mark.parametrize("scaled", [False, True])
def test_neighbours_are_found(spark, scaled):
    rng = np.random.default_rng(15)
    x = planted(rng, 1500)
    if scaled:
        x *= rng.uniform(0.2, 3, len(x)).astype(np.float32)[:, None]
    rows = [(i * 2, v.tolist(), 0, 0) for i, v in enumerate(x)]
    rows += [(1, None, 0, 0), (3, [0.0] * 64, 0, 0), (5, [float("nan")] * 64, 0, 0), (None, x[0].tolist(), 0, 0), (40_001, [1.0, 0.0], 0, 0)]
    df = spark.createDataFrame(rows, VECTORS)
    settings = neighbours.Settings(shard_rows=700, query_rows=60)
    asked = df.where("vec_id % 20 = 0 or vec_id in (1, 3, 40001)")
    out = neighbours.search(neighbours.build(df, settings), asked, 20, settings).collect()
    ids = np.arange(len(x)) * 2
    exact = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(exact, -np.inf)
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: r.rank):
        assert abs(r.score - exact[r.query_id // 2, r.vec_id // 2]) < 1e-9 * max(1, abs(r.score))
        got[r.query_id].append(r)
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    found = 0
    for query, own in got.items():
        assert [r.rank for r in own] == list(range(1, 21)) and len({r.vec_id for r in own}) == 20
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        found += len({r.vec_id for r in own} & set(ids[np.argsort(-exact[query // 2])[:20]].tolist()))
    assert found / (20 * len(got)) >= 0.9


@pytest.mark.parametrize(("alone", "copies"), [(0, 60), (600, 60), (600, 3000)])
def test_copies_hide_no_neighbours(spark, alone, copies):
    rng = np.random.default_rng(16)
    x = rng.normal(size=(alone + 1, 16)).astype(np.float32)
    x = np.concatenate([x, np.repeat(x[-1:], copies - 1, axis=0)])
    df = spark.createDataFrame([(i, v.tolist(), 0, 0) for i, v in enumerate(x)], VECTORS)
    asked = df.where(f"vec_id % 40 = 0 and vec_id <= {alone + 40}")
    out = neighbours.search(neighbours.build(df), asked, 20).collect()
    exact = x.astype(float) @ x.astype(float).T
    got = defaultdict(set)
    for r in out:
        got[r.query_id].add(r.vec_id)
    found = 0
    for q in range(0, alone + 41, 40):
        order = [i for i in np.lexsort((np.arange(len(x)), -exact[q])).tolist() if i != q][:20]
        assert len(got[q]) == 20
        found += len(got[q] & set(order))
    assert found >= 0.95 * 20 * len(got)


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], 0, 0) for i in range(4)], VECTORS)
    out = neighbours.search(neighbours.build(df), df.where("vec_id = 0"), 20).collect()
    assert [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank)] == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert neighbours.search(neighbours.build(df.limit(0)), df.limit(0), 20).count() == 0


# --- registration and pipeline --------------------------------------------------------------------------------------


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_equal_brute_force(spark):
    """Each filtering stage against a plain loop over its own input."""
    stages = dict(corpus_pipeline.STAGES)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    settings = toxicity.Settings()
    leans, bias = queries.toxicity_model(documents, spark.read.parquet(f"{SF_DIR}/labels.parquet"), settings)

    def toxic(text):
        values = [np.mean([leans[g] for g in toxicity.subwords(w, settings)]) for w in re.findall(r"\w+", (text or "").lower())]
        n = settings.window
        windows = [np.mean(values[i : i + n]) for i in range(max(1, len(values) - n + 1))] if values else [0.0]
        return 1 / (1 + np.exp(-(max(windows) + bias)))

    rows = {r.doc_id: r for r in documents.collect()}
    scores = {i: toxic(r.text) for i, r in rows.items()}
    kept = stages["toxicity"](spark, documents, SF_DIR)
    found = {r.doc_id for r in kept.collect()}
    clear = {i for i, s in scores.items() if abs(s - 0.7) > 1e-4}
    assert found & clear == {i for i in clear if scores[i] < 0.7}

    docs = documents.where(F.col("doc_id").isin(sorted(found)))
    prints = {i: plain_fingerprint(rows[i].text or "") for i in sorted(found)}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    first = {i for i, c in grouped(list(prints), pairs).items() if i == c}
    assert {r.doc_id for r in stages["simhash_near_duplicates"](spark, docs, SF_DIR).collect()} == first

    docs = documents.where(F.col("doc_id").isin(sorted(first)))
    model = pii.fit(docs)
    redacted = stages["personal_data"](spark, docs, SF_DIR)
    for r in redacted.collect():
        base, further = pii.find(rows[r.doc_id].text or "", model)
        want, at = "", 0
        for kind, start, end in sorted([*base, *further], key=lambda s: s[1]):
            if start >= at:
                want, at = want + rows[r.doc_id].text[at:start] + f"<{kind.upper()}>", end
        assert r.text == want + rows[r.doc_id].text[at:] and r.n_chars == len(r.text)
        assert not pii.base_spans(r.text)

    mixed = [r.doc_id for r in stages["mix_sources"](spark, docs, SF_DIR).collect()]
    names = {"block": "b"}
    placed = mixing.mix(docs, queries.MIX_WEIGHTS, default_weight=queries.DEFAULT_WEIGHT, block_rows=queries.BLOCK_ROWS, names=names)
    assert mixed == [r.doc_id for r in sorted(placed.collect(), key=lambda r: (r.slot, r.place))]


def test_sequences_follow_the_mix_whatever_the_files(spark, conf, tmp_path):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    words = F.concat_ws(" ", F.array_repeat(F.lit("some words"), 20))
    source = F.when(F.col("id") < 300, "src0").when(F.col("id") < 340, "src1").otherwise("src2")
    docs = spark.range(400).select(F.col("id").alias("doc_id"), source.alias("source"), words.alias("text"))
    names = {"block": "b"}
    placed = mixing.mix(docs, queries.MIX_WEIGHTS, default_weight=queries.DEFAULT_WEIGHT, block_rows=queries.BLOCK_ROWS, names=names)
    want = [r.doc_id for r in sorted(placed.collect(), key=lambda r: (r.slot, r.place))]
    out, at = str(tmp_path / "mixed"), 0
    for size in (10, 200, 40, 150):  # files of unequal size
        part = [(i, "src0" if i < 300 else "src1" if i < 340 else "src2", "some words " * 20) for i in want[at : at + size]]
        spark.createDataFrame(part, docs.schema).coalesce(1).write.mode("append").parquet(out)
        at += size
    mixed = spark.read.parquet(out)
    placed = mixing.mix(mixed, queries.MIX_WEIGHTS, default_weight=queries.DEFAULT_WEIGHT, block_rows=queries.BLOCK_ROWS, names=names)
    want = [r.doc_id for r in sorted(placed.collect(), key=lambda r: (r.slot, r.place))]
    pieces = dict(corpus_pipeline.STAGES)["pack_sequences"](spark, mixed, SF_DIR).collect()
    assert len({p.sequence_id >> 40 for p in pieces}) > 1
    ordered = sorted(pieces, key=lambda p: (p.sequence_id >> 40, want.index(p.doc_id), p.start))
    assert list(dict.fromkeys(p.doc_id for p in ordered)) == want
    spans = defaultdict(list)
    for p in pieces:
        spans[p.sequence_id >> 40].append(want.index(p.doc_id))
    assert all(sorted(set(s)) == list(range(min(s), max(s) + 1)) for s in spans.values())


def test_pipeline(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in documents.schema], name
        docs = spark.createDataFrame(out.collect(), out.schema).coalesce(1)
        kept[name] = docs.count()
    assert documents.count() >= kept["toxicity"] >= kept["simhash_near_duplicates"] == kept["mix_sources"]
    assert docs.where(r"text rlike '[a-z]+[.][0-9]+@mail[0-9]'").count() == 0
    assert docs.where("n_chars != length(text)").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    check_pieces(pieces, library_ids(spark, docs))
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in whole.collect()} == {p.doc_id for p in pieces}
    assert sum(r.length for r in whole.collect()) == sum(p.length for p in pieces)


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row string, simhash string, id int, piece int, m map<string,int>"


def odd_documents(spark):
    texts = [None, "", "  ", "one two three four", "one two three four", "word " * 30_000, "mail a.b@example.org now", "é" * 300, "five six seven"]
    rows = [(None if i % 3 == 0 else i, t, None, None if i % 4 == 0 else "src0", None, "r", "s", i, 1, {"a": i}) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[3], rows[8]], CLASHING)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_empty_tables(spark, name):
    stage, docs = dict(corpus_pipeline.STAGES)[name], odd_documents(spark)
    rows, none = stage(spark, docs, SF_DIR).collect(), stage(spark, docs.limit(0), SF_DIR)
    assert none.count() == 0
    if name == "pack_sequences":
        long = [r for r in rows if r.doc_id == 5]
        assert sum(r.length for r in long) == long[0].doc_tokens > 4096
        assert sum(r.doc_tokens == 1 for r in rows) == 3  # null, empty and blank
        return
    assert none.schema == docs.schema or none.columns == docs.columns
    assert all(r.row == "r" and r.m is not None and r.piece == 1 for r in rows)
    texts = Counter(r.text for r in rows)
    if name == "simhash_near_duplicates":
        # null, empty and blank are one group, of repeated rows one stays
        assert len(rows) == 6 and max(texts.values()) == 1 and sum(not (t or "").strip() for t in texts) == 1
    else:
        assert len(rows) == 11 and texts[None] == 1 and texts[""] == 1 and texts["word " * 30_000] == 1
    if name == "personal_data":
        assert texts["mail <EMAIL> now"] == 1


def test_folders_of_stages_are_removed(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "a b c", "en", "src0", 5)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    monkeypatch.setattr(corpus_pipeline, "scratch_root", lambda spark: str(tmp_path / "scratch"))
    keep = ("first", lambda spark, docs, sf_dir: docs)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [keep, ("second", keep[1]), ("third", keep[1])])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1
    assert [f.name for f in (tmp_path / "scratch").glob("*/*")] == ["2-third"]

    def fails(spark, docs, sf_dir):
        raise OSError("lost")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [keep, ("second", fails)])
    with pytest.raises(OSError):
        corpus_pipeline.run(spark, str(tmp_path))
    assert [f.name for f in (tmp_path / "scratch").glob("*/*")] == ["2-third"]


def test_a_repeated_query_asks_with_its_smallest_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    points = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = neighbours.build(points)
    asked = spark.createDataFrame([(7, rows[9][1]), (7, rows[4][1])], points.schema)
    found = [r.vec_id for r in neighbours.search(index, asked, 1).collect()]
    smallest = min(rows[9][1], rows[4][1])
    want = max((i for i, _ in rows if i != 7), key=lambda i: np.dot(rows[i][1], smallest))
    assert found == [want]


def test_points_of_many_shards_are_not_copied_for_each_block_of_queries(spark):
    rng = np.random.default_rng(5)
    points = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(2000)], "vec_id long, embedding array<double>")
    settings = neighbours.Settings(shard_rows=20, query_rows=10)
    index = neighbours.build(points, settings)
    assert index.points.select("shard").distinct().count() > 2 * spark.sparkContext.defaultParallelism
    found = neighbours.search(index, points.where("vec_id % 20 = 0"), 3, settings)
    assert found.count() == 300
