"""Reconcile, change batches, chunks, points and the store; batches against a sequential model."""

import random

import pytest
from pyspark.sql import functions as F

from siltmark.operators import changes as ch
from siltmark.operators import chunking as ck
from siltmark.operators import embedding as em
from siltmark.operators import reconcile as rc
from siltmark.operators.store import IndexStore
from siltmark.schema import CHANGES, DISK, INDEXED, POINTS


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_reconcile(spark):
    disk = spark.createDataFrame([("a.md", "h1"), ("b.md", "h1"), ("c.md", "h1"), ("d.md", "h2"), ("e.md", "h3")], DISK)
    indexed = spark.createDataFrame([("b.md", "h1"), ("d.md", "h2"), ("e.md", "old"), ("z.md", "h9")], INDEXED)
    plan = {r.rel_path: r.action for r in rc.reconcile(disk, indexed).collect()}
    assert plan == {"a.md": "upserted", "b.md": "dup_removed", "c.md": "dup_ignored", "d.md": "skipped", "e.md": "upserted", "z.md": "stale_removed"}
    assert {r.action for r in rc.reconcile(disk.limit(0), indexed).collect()} == {"stale_removed"}
    points = spark.createDataFrame([("2", "a", "x"), ("1", "a", None), ("3", "", "y"), ("4", None, "y")], "id string, source_path string, file_hash string")
    assert rows(rc.indexed_paths(points)) == [("a", "")] and rc.indexed_hash(points, "a").isEmpty()


def test_prefixes(spark):
    points = spark.createDataFrame([("sub/a",), ("sub",), ("subway/a",), ("x/sub/a",), ("y",)], "source_path string")
    assert rows(rc.delete_prefix(points, "/sub/")) == [("subway/a",), ("x/sub/a",), ("y",)]
    assert rc.delete_prefix(points, "/").count() == 5
    many = spark.createDataFrame([("sub",), ("x/sub/",), ("",)], "path string")
    assert rows(rc.delete_prefixes(points, many)) == [("subway/a",), ("y",)]


def sequential(changes, disk, indexed):
    """Deletes in order, then upserts in order, one after the other."""
    index = dict(indexed)
    latest, order = {}, []
    for op, path, prefix in changes:
        if (path, prefix) not in latest:
            order.append((path, prefix))
        latest[(path, prefix)] = op

    def upsert(p, force=False):
        if p not in disk:
            index.pop(p, None)
        elif not force and min(q for q in disk if disk[q] == disk[p]) != p:
            index.pop(p, None)
        else:
            index[p] = disk[p]

    for path, prefix in order:
        if latest[(path, prefix)] != "delete":
            continue
        if prefix:
            top = path.strip("/")
            for q in [q for q in index if top and (q == top or q.startswith(top + "/"))]:
                del index[q]
            continue
        held = index.pop(path, None)
        peers = sorted(q for q in disk if disk[q] == held) if held else []
        if peers and path < peers[0]:
            upsert(peers[0], force=True)
    for path, prefix in order:
        if latest[(path, prefix)] == "upsert" and not prefix:
            upsert(path)
    return index


@pytest.mark.parametrize("seed", range(8))
def test_batches_equal_the_sequential_model(spark, seed):
    rng = random.Random(seed)
    names = ["a.md", "b.md", "d/a.md", "d/b.md", "d/e/c.md", "z.md"]
    disk = {n: rng.choice("hij") for n in names if rng.random() < 0.6}
    indexed = {n: rng.choice("hij") for n in names if rng.random() < 0.7}
    changes = []
    for _ in range(rng.randint(1, 6)):
        prefix = rng.random() < 0.3
        path = rng.choice(["d", "d/e", "a.md"]) if prefix else rng.choice(names)
        op = "delete" if prefix or rng.random() < 0.5 else "upsert"
        if op == "delete" and not prefix and path in disk and rng.random() < 0.7:
            del disk[path]
        changes.append((op, path, prefix))
    batch = spark.createDataFrame([(i, *c) for i, c in enumerate(changes)], CHANGES)
    plan = ch.apply_changes(batch, spark.createDataFrame(list(disk.items()) or [("q", "q")][:0], DISK), spark.createDataFrame(list(indexed.items()), INDEXED))
    got = {r.source_path: r.file_hash for r in plan.collect() if r.action != "deleted"}
    assert got == sequential(changes, disk, indexed)


@pytest.mark.parametrize("seed", range(2))
def test_chains_of_promotions(spark, seed):
    rng = random.Random(seed)
    indexed = {f"n{i:02}": f"h{i}" for i in range(40)} | {"m07": "h7"}
    disk = {f"n{i + 1:02}": f"h{i}" for i in range(40)}
    changes = [("delete", p, False) for p in indexed]
    if seed:
        rng.shuffle(changes)
    batch = spark.createDataFrame([(i, *c) for i, c in enumerate(changes)], CHANGES)
    plan = ch.apply_changes(batch, spark.createDataFrame(list(disk.items()), DISK), spark.createDataFrame(list(indexed.items()), INDEXED))
    got = {r.source_path: r.file_hash for r in plan.collect() if r.action != "deleted"}
    assert got == sequential(changes, disk, indexed)


def test_more_promotions_than_a_driver_takes(spark):
    n = 110_000
    name = lambda x: F.concat(F.lit(x), "id")
    batch = spark.range(n).select(F.col("id").alias("seq"), F.lit("delete").alias("op"), name("a").alias("path"), F.lit(False).alias("is_prefix"))
    disk = spark.range(n).select(name("b").alias("rel_path"), name("h").alias("file_hash"))
    indexed = spark.range(n).select(name("a").alias("source_path"), name("h").alias("file_hash"))
    plan = ch.apply_changes(batch, disk, indexed).groupBy(F.substring("source_path", 1, 1), "action").count()
    assert rows(plan) == [("a", "deleted", n), ("b", "upserted", n)]


def test_events(spark):
    events = [(1, "created", "/t/a", None, False), (2, "created", "/t/d", None, True), (3, "deleted", "/t/d", None, True), (4, "moved", "/t/a", "/t/b", False), (5, "moved", "/o/x", "/t/n", True), (6, "opened", "/t/a", None, False), (7, "modified", "/t", None, False), (8, "moved", "/t/c", "/o/c", False)]
    df = spark.createDataFrame(events, "seq long, event_type string, src_path string, dest_path string, is_directory boolean")
    listing = spark.createDataFrame([("n/1",), ("n/m/2",), ("nn/3",)], "rel_path string")
    got = rows(ch.event_changes(df, "/t", listing))
    assert got == sorted([(1, "upsert", "a", False), (3, "delete", "d", True), (4, "delete", "a", False), (4, "upsert", "b", False), (5, "upsert", "n/1", False), (5, "upsert", "n/m/2", False), (8, "delete", "c", False)], key=repr)
    changes = spark.createDataFrame([(1, "upsert", "a", False), (2, "delete", "a", False), (3, "upsert", "b", False), (4, "delete", "b", True)], CHANGES)
    assert rows(ch.coalesce_changes(changes)) == [(1, "delete", "a", False), (3, "upsert", "b", False), (4, "delete", "b", True)]


def test_quiet_batches(spark):
    rng = random.Random(2)
    at = sorted(rng.uniform(0, 300) for _ in range(120))
    df = spark.createDataFrame([(t,) for t in at], "s double").select(F.timestamp_seconds("s").alias("ts"))
    for gap in (0.5, 1.0, 5.0):
        sizes, n = [], 1
        for a, b in zip(at, at[1:], strict=False):
            if round(b, 6) - round(a, 6) >= gap:
                sizes.append(n)
                n = 0
            n += 1
        assert [r.n for r in ch.quiet_batches(df, gap).orderBy("start").collect()] == [*sizes, n]


def test_snapshots(spark):
    kind = "rel_path string, size long, mtime double"
    before = spark.createDataFrame([("same", 1, 1.0), ("grown", 1, 1.0), ("gone", 1, 1.0), ("busy", 1, 1.0)], kind)
    listed = spark.createDataFrame([("same", 1, 1.0), ("grown", 2, 1.0), ("new", 1, 1.0), ("busy", 5, 1.0)], kind)
    again = spark.createDataFrame([("same", 1, 1.0), ("grown", 2, 1.0), ("new", 1, 1.0), ("busy", 6, 1.0)], kind)
    stable = ch.stable_files(listed, again)
    assert rows(ch.snapshot_delta(before, listed, stable)) == [("gone", "delete"), ("grown", "upsert"), ("new", "upsert")]
    assert rows(ch.next_mirror(before, listed, stable)) == [("busy", 1, 1.0), ("grown", 2, 1.0), ("new", 1, 1.0), ("same", 1, 1.0)]


MD = "| a | b |\n|---|---|\n| 1 | 2 |"


def items(spark, *found):
    return spark.createDataFrame([("f", *x) for x in found], ck.ITEMS)


def test_assembly(spark):
    df = items(
        spark, (0, 0, "prose", "p0", ["H", ""], "before", None), (0, 1, "table", "t0", ["H"], MD, "cap"), (0, 2, "prose", "p1", ["H"], "after", None), (1, 0, "table", "t0", [], MD, "cap"), (1, 1, "prose", "p1", [], "after", None),
        (2, 0, "prose", "p2", [], "| 1 | 2 |", None), (3, 0, "prose", "p3", ["K"], "tail", None), (4, 0, "prose", "p4", [], "| x | y |\n|---|---|\n| 8 | 9 |", None), (5, 0, "prose", "p5", [], "--- | ---", None),
    )
    registry = spark.createDataFrame([("f", "t0", MD, "cap"), ("f", "t9", MD.replace("1", "7"), None)], "rel_path string, ref string, text string, caption string")
    chunks = ck.assemble_chunks(df, 100, registry).orderBy("chunk_no").collect()
    assert [c.text for c in chunks] == ["before", "Подпись таблицы: cap\n\n" + MD, "after", "K\ntail", "| x | y |\n|---|---|\n| 8 | 9 |", MD.replace("1", "7")]
    assert [c.chunk_no for c in chunks] == list(range(6)) and chunks[4].table_ref.startswith("markdown:4:") and chunks[5].table_ref == "t9"
    assert chunks[0].headings == ["H"] and chunks[1].row_count == 1 and chunks[5].headings == [] and all(c.error is None for c in chunks)
    assert ck.table_invariant(ck.assemble_chunks(df, 100, registry), registry).filter("ref like 't%'").isEmpty()
    bad = ck.assemble_chunks(items(spark, (0, 0, "table", "t0", [], "| - |", None)), 100).collect()
    assert bad[0].error


def test_points(spark):
    chunks = spark.createDataFrame([("f", "h", 0, "one", ["A"], "prose", None, [], 0), ("f", "h", 1, "--", [], "prose", None, [], 0), ("f", "h", 2, "two", [], "table", "t", ["p", " ", "q"], 3), ("g", "h", 0, "bad", [], "prose", None, [], 0)], "rel_path string, file_hash string, chunk_no int, text string, headings array<string>, chunk_type string, table_ref string, embedding_parts array<string>, row_count int")

    def embed(texts):
        if "bad" in texts:
            raise RuntimeError("no")
        return [[float(len(t)), 1.0] for t in texts]

    done = em.embed_chunks(chunks, em.python_embedder(embed, 1))
    made = em.points(done).orderBy("chunk_index").collect()
    assert [(p.chunk_index, p.text, p.headings, p.table_ref, p.row_count) for p in made] == [(0, "one", ["A"], None, None), (1, "two", None, "t", 3)]
    assert {r.rel_path for r in done.filter("failed").collect()} == {"g"}


def point(i, path, vector):
    return (i, vector, path, 0, "t", "h", "v", "prose", None, None, None)


def test_store(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"))
    assert store.read().count() == 0 and store.dimension() is None
    first = spark.createDataFrame([point("1", "a", [1.0, 2.0]), point("2", "b", [1.0, 2.0])], POINTS)
    assert store.commit(first) == 1 and store.dimension() == 2
    touched = spark.createDataFrame([("a",)], "source_path string")
    old = store.read()
    assert store.replace(touched, spark.createDataFrame([point("3", "a", [0.0, 1.0])], POINTS)) == 2
    assert {r.id for r in store.read().collect()} == {"2", "3"} and {r.id for r in old.collect()} == {"1", "2"}
    with pytest.raises(ValueError, match="length 2"):
        store.replace(touched, spark.createDataFrame([point("4", "a", [1.0])], POINTS))
    store.commit(first)
    store.vacuum(1)
    assert store.versions() == [3] and store.read().count() == 2
    everything = spark.createDataFrame([("a",), ("b",)], "source_path string")
    store.replace(everything, spark.createDataFrame([], POINTS))
    assert store.read().count() == 0 and store.dimension() is None
    store.replace(touched, spark.createDataFrame([point("5", "a", [1.0])], POINTS))
    assert store.dimension() == 1


def test_store_writes_touched_buckets_only(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), buckets=8)
    rows = [point(str(i), f"p{i}", [float(i)]) for i in range(60)]
    store.commit(spark.createDataFrame(rows, POINTS))
    before = store._version(1)["folders"]
    store.replace(spark.createDataFrame([("p7",)], "source_path string"), spark.createDataFrame([point("x", "p7", [0.5])], POINTS))
    after = store._version(2)["folders"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert {r.id for r in store.read().collect()} == {str(i) for i in range(60) if i != 7} | {"x"}
    store.vacuum(1)
    assert store.read().count() == 60 and len(list((tmp_path / "index/data").iterdir())) == 2
    store.replace(spark.createDataFrame([(f"p{i}",) for i in range(60)], "source_path string"), spark.createDataFrame([], POINTS))
    store.vacuum(1)
    assert store.read().count() == 0


def test_store_survives_crashes(spark, tmp_path, monkeypatch):
    from siltmark.operators import store as module

    store = IndexStore(spark, str(tmp_path / "index"))
    store.commit(spark.createDataFrame([point("1", "a", [1.0])], POINTS))
    touched, fresh = spark.createDataFrame([("a",)], "source_path string"), spark.createDataFrame([point("2", "a", [2.0])], POINTS)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # after the data, before the version
        m.setattr(module, "publish", dies)
        with pytest.raises(RuntimeError, match="lost"):
            store.replace(touched, fresh)
    (tmp_path / "index/versions/.0000000002.half").write_text("{")  # while the version was being written
    assert [r.id for r in store.read().collect()] == ["1"] and store.versions() == [1]
    assert store.replace(touched, fresh) == 2 and [r.id for r in store.read().collect()] == ["2"]
    with monkeypatch.context() as m:  # another writer commits between the first look and the version
        real = module.publish
        m.setattr(module, "publish", lambda s, p, c: real(s, p, store.folder and module.json.dumps(store._version(2))) and real(s, p, c))
        with pytest.raises(RuntimeError, match="another writer"):
            store.replace(touched, spark.createDataFrame([point("3", "a", [3.0])], POINTS))
    assert [r.id for r in store.read().collect()] == ["2"] and store.versions() == [1, 2, 3]
    assert module.publish(spark, str(tmp_path / "one"), "x") and not module.publish(spark, str(tmp_path / "one"), "y") and (tmp_path / "one").read_text() == "x"


def test_one_request_for_a_document(spark):
    asked = spark.sparkContext.accumulator(0)
    chunks = spark.createDataFrame([("f", i, f"text {i}", ["a", "b"][: i % 3]) for i in range(7)] + [("g", 0, "only", [])], "rel_path string, chunk_no int, text string, embedding_parts array<string>").repartition(3)

    def embed(texts):
        asked.add(1)
        return [[float(len(t)), 1.0] for t in texts]

    done = sorted(em.embed_chunks(chunks, em.python_embedder(embed)).collect(), key=lambda r: (r.rel_path, r.chunk_no))
    assert asked.value == 2 and [(r.rel_path, r.chunk_no, r.chunk_index) for r in done] == [("f", i, i) for i in range(7)] + [("g", 0, 0)]
    assert done[0].vector == [6.0, 1.0] and abs(done[1].vector[0] - 1.0) < 1e-9 and done[7].vector == [4.0, 1.0] and not any(r.failed for r in done)


def test_vectors_are_computed_once(spark):
    chunks = spark.createDataFrame([("f", 0, "one"), ("f", 1, "two"), ("g", 0, "x")], "rel_path string, chunk_no int, text string").select("*", F.array("text", F.lit("b")).alias("embedding_parts"))
    done = em.embed_chunks(chunks, lambda texts: F.transform(texts, lambda t: F.array(F.char_length(t) + 123456.0, F.lit(1.0))))
    for asked in (done.groupBy("rel_path").agg(F.max("failed").alias("failed")), done.filter(~F.col("failed") & F.col("vector").isNotNull())):
        assert asked._jdf.queryExecution().optimizedPlan().toString().count("123456.0") == 1
        assert {r.rel_path for r in asked.collect() if not r.failed} == {"f", "g"}


def test_peers_are_merged(spark):
    kinds = ["prose", "prose", "prose", "table", "prose", "prose", "prose", "prose", "prose"]
    heads = [["A"], ["A"], ["B"], ["B"], ["B"], ["B"], ["B"], ["B"], None]
    texts = ["one", "two", "three", MD, "four", "x" * 300, "five", "six", "seven"]
    df = items(spark, *[(i, 0, k, f"r{i}", h, t, None) for i, (k, h, t) in enumerate(zip(kinds, heads, texts, strict=True))])
    got = [(r.raw, r.ord, r.text) for r in ck.merge_peers(df, 64).orderBy("raw", "ord").collect()]
    assert got == [(0, 0, "one"), (0, 1, "two"), (1, 0, "three"), (2, 0, MD), (3, 0, "four"), (4, 0, "x" * 300), (5, 0, "five"), (5, 1, "six"), (6, 0, "seven")]
    chunks = [c.text for c in ck.assemble_chunks(ck.merge_peers(df, 64), 64).orderBy("chunk_no").collect()]
    assert chunks[:3] == ["A\none\n\ntwo", "B\nthree", MD] and chunks[-2:] == ["B\nfive\n\nsix", "seven"]
    assert ck.merge_peers(df.limit(0), 64).count() == 0


def test_a_document_without_path_is_one_document(spark):
    df = items(spark, (0, 0, "table", "t0", [], MD, None), (1, 0, "prose", "p0", [], "| 1 | 2 |", None), (2, 0, "prose", "p1", [], "tail", None), (3, 0, "table", "t1", [], "| - |", None)).withColumn("rel_path", F.lit(None).cast("string"))
    assert [(c.chunk_no, c.text, bool(c.error)) for c in ck.assemble_chunks(df, 100).orderBy("chunk_no").collect()] == [(0, MD, True), (1, "tail", True), (2, "| - |", True)]


def test_prose_without_reference_is_no_repeat(spark):
    df = items(spark, (0, 0, "prose", None, [], "before", None), (0, 1, "table", "t0", [], MD, None), (0, 2, "prose", None, [], "after", None))
    assert [c.text for c in ck.assemble_chunks(df, 100).orderBy("chunk_no").collect()] == ["before", MD, "after"]


def test_broken_invariant_fails_the_document(spark):
    df = items(spark, (0, 0, "prose", "p0", [], "text", None))
    twice = spark.createDataFrame([("f", "t0", MD, None), ("f", "t0", MD.replace("1", "7"), None)], "rel_path string, ref string, text string, caption string")
    assert all("twice" in c.error for c in ck.assemble_chunks(df, 100, twice).collect())


def test_chunks_by_a_tokenizer(spark):
    words = lambda t: len(t.split())
    rows = "\n".join(f"| {i} | some longer words {i} |" for i in range(9))
    text = "\n".join(f"line {i} of the prose" for i in range(6)) + "\n" + " ".join(f"w{i}" for i in range(60)) + "\nend"
    df = items(spark, (0, 0, "prose", "p0", [], text, None), (1, 0, "table", "t0", ["H"], "| a | b |\n|---|---|\n" + rows, "cap"), (2, 0, "prose", "p1", [], "| x | y |\n|---|---|\n| 8 | 9 |\nshort", None))
    chunks = ck.assemble_chunks(df, 20, tokenizer=words).orderBy("chunk_no").collect()
    prose = [c.text for c in chunks if c.chunk_type == "prose"]
    assert prose[:2] == ["\n".join(f"line {i} of the prose" for i in r) for r in (range(4), range(4, 6))] and prose[-2:] == ["end", "short"]
    assert "".join(prose[2:-2]).startswith("w0 w1") and all(len(p) <= 80 for p in prose[2:-2])
    table = next(c for c in chunks if c.table_ref == "t0")
    head = "[Таблица]\nРаздел: H\nПодпись: cap\n\n| a | b |\n|---|---|\n"
    assert len(table.embedding_parts) == 9 and table.embedding_parts[3] == head + "| 3 | some longer words 3 |"
    assert [c.text for c in chunks if c.chunk_type == "table"][1:] == ["| x | y |\n|---|---|\n| 8 | 9 |"]
    every = ck.assemble_chunks(df, 1000, tokenizer=words).orderBy("chunk_no").collect()
    plain = ck.assemble_chunks(df, 1000).orderBy("chunk_no").collect()
    assert [c.embedding_parts for c in every] == [c.embedding_parts for c in plain] and [c.text for c in every] == [c.text for c in plain]
