"""Trees, readers, remotes, settings and the engine end to end."""

import hashlib
import json
import os
import time

import pytest

from siltmark import config, embedder
from siltmark.engine import Engine, LocalWatch, TreeIndexer
from siltmark.operators.embedding import stub_embedder
from siltmark.operators.store import IndexStore
from siltmark.sources import doctree, readers, remote
from siltmark.sources.remote import Change, Meta, StagedSource


def put(root, name, data):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def test_doctree(spark, tmp_path):
    for name in ("a.md", "_u.md", ".hidden.md", ".dir/b.md", "_dir/c.TXT", "k=v/d.md", "Папка/é %20.md", "x.bin", "deep/er/e.html"):
        put(tmp_path, name, b"data")
    put(tmp_path, "empty.md", b"")
    os.symlink(tmp_path / "a.md", tmp_path / "link.md")
    os.symlink(tmp_path / "deep", tmp_path / "linkdir")
    doctree.register(spark)
    found = {r.rel_path: (r.size, bytes(r.content)) for r in spark.read.format("doctree").option("content", "true").load(str(tmp_path)).collect()}
    assert set(found) == {"a.md", "_u.md", ".dir/b.md", "_dir/c.TXT", "k=v/d.md", "Папка/é %20.md", "deep/er/e.html", "empty.md", "link.md"}
    assert found["empty.md"] == (0, b"") and found["a.md"] == (4, b"data")
    only = spark.read.format("doctree").option("extensions", "html").load(str(tmp_path))
    assert [r.rel_path for r in only.collect()] == ["deep/er/e.html"]
    listing = spark.read.format("doctree").load(str(tmp_path)).drop("content")
    read = {r.rel_path: (r.size, bytes(r.content)) for r in doctree.with_content(listing, str(tmp_path)).collect()}
    assert read == found
    hashes = {r.rel_path: r.file_hash for r in doctree.hashed(listing, str(tmp_path)).collect()}
    assert hashes == {n: hashlib.sha256(b"table-aware-v2\0" + c).hexdigest() for n, (_, c) in found.items()}
    (tmp_path / "a.md").unlink()
    assert doctree.with_content(spark.createDataFrame([("a.md",), ("_u.md",)], "rel_path string"), str(tmp_path)).count() == 1


def test_a_single_directory_is_listed_in_parallel(tmp_path):
    for i in range(40):
        put(tmp_path, f"only/d{i}/f.md", b"x")
    for i in range(2500):
        put(tmp_path, f"only/many/{i}.md", b"")
    parts = doctree.DocTreeReader({"path": str(tmp_path)}).partitions()
    listed = [list(doctree.DocTreeReader({"path": str(tmp_path)}).read(p)) for p in parts]
    assert len(parts) >= 3 and sum(map(len, listed)) == 2540 and len({x[0] for part in listed for x in part}) == 2540


def test_readers():
    md = b"# T\nintro\n\n## S\n| a | b |\n|---|---|\n| 1 | 2 |\nafter\n# U\nend"
    got = [(k, h, t) for k, h, t in readers.read_markdown(md)]
    assert got == [("prose", ["T"], "intro"), ("table", ["T", "S"], "| a | b |\n|---|---|\n| 1 | 2 |"), ("prose", ["T", "S"], "after"), ("prose", ["U"], "end")]
    html = b"<head><title>x</title></head><body><nav>n</nav><h1>A</h1><p>one <b>two</b></p><table><tr><th>h</th><th>i</th></tr><tr><td>1</td><td>a|b</td></tr></table><ul><li>q</li></ul>"
    assert list(readers.read_html(html)) == [("prose", ["A"], "one two"), ("table", ["A"], "| h | i |\n|---|---|\n| 1 | a\\|b |"), ("prose", ["A"], "q")]
    assert list(readers.read_csv(b"a;b\n1;2\n")) == [("table", [], "| a | b |\n|---|---|\n| 1 | 2 |")]
    assert readers.read_items("x.xls", b"")[0][-1].startswith("ValueError: no reader") and "not a PDF" in readers.read_items("x.pdf", b"")[0][-1] and "unsupported" in readers.read_items("x.exe", b"")[0][-1]
    assert readers.read_items("x.txt", None) == []


def test_html_with_omitted_tags():
    read = lambda x: list(readers.read_html(x.encode()))
    table = lambda *rows: ("table", [], readers.pipe_table([list(r) for r in rows]))
    page = "<head><title>t</title><style>s</style>"
    assert read(page + "<body><h1>A</h1><p>one") == [("prose", ["A"], "one")]
    assert read(page + "<p>one<p>two") == [("prose", [], "one"), ("prose", [], "two")]
    assert read(page + " one <b>two</b>") == [("prose", [], "one two")]
    assert read(page + "</head><body><nav>n</nav>one") == [("prose", [], "one")]
    assert read("<table><tr><td>a<td>b<tr><th>c<td>d</table>e") == [table("ab", "cd"), ("prose", [], "e")]
    assert read("<table><thead><tr><th>a<th>b<tbody><tr><td>c<td>d") == [table("ab", "cd")]
    assert read("<table><td>a<td>b</tr><td>c</table>") == [table("ab", "c")]
    assert read("<table><tr><td>a<table><tr><td>x</table>b<td>c</tr><tr><td>d</td></tr></table>") == [table("x"), table(["ab", "c"], "d")]
    assert read("<table><tr><td>a<nav>n<td>b<template><tr><td>x</template>c</table>d") == [table(["a", "bc"]), ("prose", [], "d")]
    assert read("<nav><table><tr><td>n</table></nav>a") == read("<nav><table><tr><td>n</nav>a") == [("prose", [], "a")]


def test_references_without_semicolon():
    page = b"<p title='&amp'>a&amp</p><p>&lt;b&gt &#38; &#x26; &#38 &nosuch; &notit;</p>"
    assert [t for _, _, t in readers.read_html(page)] == ["a&", "<b> & & & &nosuch; \u00acit;"]
    assert [t for _, _, t in readers.read_html(page, closed=True)] == ["a&amp", "<b&gt & & &#38 &nosuch; &notit;"]


def test_registered_readers_reach_the_workers(spark, monkeypatch):
    monkeypatch.setattr(readers, "_registered", {})
    readers.register(".PDF", lambda data: [("prose", ["T"], data.decode().upper())])
    files = spark.createDataFrame([("d/x.pdf", b"text"), ("y.xls", b"z")], "rel_path string, content binary")
    found = {r.rel_path: (r.headings, r.text, r.error) for r in readers.read_documents(files).collect()}
    assert found["d/x.pdf"] == (["T"], "TEXT", None) and "no reader" in found["y.xls"][2]


class FakeRemote:
    def __init__(self):
        self.files, self.broken, self.changing = {}, False, set()

    def list_files(self):
        if self.broken:
            raise remote.ListingError("down")
        return {p: Meta(len(d), t) for p, (d, t) in self.files.items()}

    def stat(self, path):
        d, t = self.files[path]
        return Meta(len(d) + (path in self.changing), t)

    def download(self, path, to):
        to.write_bytes(self.files[path][0])


def test_staging(tmp_path):
    far = FakeRemote()
    far.files = {"a.md": (b"1", 1.0), "d/b.md": (b"2", 1.0), ".x.md": (b"3", 1.0), "c.exe": (b"4", 1.0), "busy.md": (b"5", 1.0)}
    far.changing = {"busy.md"}
    source = StagedSource(far, str(tmp_path / "s"), ["md"])
    assert source.prepare() == tmp_path / "s" and source.mirrored.keys() == {"a.md", "d/b.md"} and not (tmp_path / "s/busy.md").exists()
    far.changing = set()
    del far.files["d/b.md"]
    far.files["a.md"] = (b"11", 2.0)
    assert source.sync() == [Change("upsert", "a.md"), Change("upsert", "busy.md"), Change("delete", "d/b.md")] and not (tmp_path / "s/d").exists()
    assert source.sync() == []
    far.broken = True
    with pytest.raises(remote.ListingError):
        source.sync()
    again = StagedSource(far, str(tmp_path / "s"), ["md"])
    with pytest.raises(remote.ListingError):
        again.prepare()
    assert again.mirrored == source.mirrored
    manifest = tmp_path / "s" / remote.MANIFEST
    manifest.write_text(json.dumps({"files": {"a": {"size": 1, "mtime": 2}, "b": 3, "c": {"size": "x"}}}))
    assert remote.load_manifest(manifest) == {"a": Meta(1, 2.0)}
    manifest.write_text("{oops")
    assert remote.load_manifest(manifest) == {}
    source.failures = 4
    assert source.delay() == 60.0


def test_settings(tmp_path):
    env = tmp_path / ".env"
    env.write_text("MODELS__CHUNK_SIZE=99\nSOURCE__WATCH_PATH='/x'\nNOISE=1\n")
    s = config.load_settings(env, {"MODELS__CHUNK_SIZE": "77"})
    assert s.models.chunk_size == 77 and s.source.watch_path == "/x"
    smb = config.load_settings(None, {"SOURCE__SERVER": "s", "SOURCE__SHARE": "d", "SOURCE__USERNAME": "u", "SOURCE__PASSWORD": "pw", "SOURCE__STAGING_PATH": "/y"})
    assert smb.source.kind == "smb" and "pw" not in str(smb.safe()) and smb.source.poll_interval_sec == 15
    other = config.load_settings(None, {"QDRANT__COLLECTION": "c", "QDRANT__URL": "/i", "MODELS__OLLAMA_BASE_URL": "http://o", "MODELS__PICTURE_AREA_THRESHOLD": "0.5"})
    assert (other.index.collection, other.index.path, other.models.base_url, other.models.picture_area_threshold) == ("c", "/i", "http://o", 0.5)
    assert (s.models.picture_description_enabled, s.models.vlm_timeout_sec, s.models.vlm_concurrency, s.index.collection) == (True, 90.0, 2, "docs")
    for bad in ({"SOURCE__SERVER": "s"}, {"INDEX_EXTENSIONS": "exe"}, {"MODELS__WHAT": "1"}):
        with pytest.raises(ValueError):
            config.load_settings(None, bad)


def test_embedding_answers():
    v = embedder.vectors_of
    assert v({"embeddings": [[1, 2], [3, 4]]}, 2) == [[1.0, 2.0], [3.0, 4.0]] and v({"embedding": [1]}, 1) == [[1.0]]
    assert v({"embeddings": [[1], [2]]}, 1) == [[1.0]] and v({"embeddings": [[[1, 2]]]}, 1) == [[1.0, 2.0]]
    assert v({"embeddings": [["x"]]}, 1) is None and v([], 1) is None and v({"embedding": [1]}, 2) is None
    with pytest.raises(ValueError):
        embedder.HttpEmbedder()(["a", " "])
    assert embedder.HttpEmbedder()([]) == [] and embedder.chat_url("http://h/") == "http://h/v1/chat/completions"


def test_engine(spark, tmp_path):
    docs = tmp_path / "docs"
    put(docs, "a.md", b"# H\nsame text")
    put(docs, "sub/a.md", b"# H\nsame text")
    put(docs, "b.md", b"other")
    put(docs, "junk.md", b"---")
    put(docs, "p.pdf", b"%PDF")
    store = IndexStore(spark, str(tmp_path / "index"), buckets=4)
    indexer = TreeIndexer(spark, store, stub_embedder, max_tokens=64)
    have = lambda: {r.source_path for r in store.read().select("source_path").distinct().collect()}
    counts = indexer.index(str(docs))
    assert have() == {"a.md", "b.md"} and counts == {"upserted": 4, "dup_ignored": 1}
    assert indexer.index(str(docs), []) == {}
    (docs / "a.md").unlink()
    indexer.index(str(docs), [Change("delete", "a.md")])
    assert have() == {"sub/a.md", "b.md"}
    put(docs, "b.md", b"changed")
    indexer.index(str(docs), [Change("upsert", "b.md")])
    assert [r.text for r in store.read().filter("source_path = 'b.md'").collect()] == ["changed"]
    assert len(store.versions()) <= 2  # older ones are dropped
    before = os.stat(docs / "b.md")
    put(docs, "b.md", b"CHANGED")  # of the same size, and time
    os.utime(docs / "b.md", ns=(before.st_atime_ns, before.st_mtime_ns))
    put(docs, "sub/c.md", b"unheard of")
    indexer.index(str(docs), [Change("upsert", "b.md")])  # a file that a batch names is hashed anew
    assert [r.text for r in store.read().filter("source_path = 'b.md'").collect()] == ["CHANGED"] and have() == {"sub/a.md", "b.md"}
    indexer.index(str(docs), [Change("delete", "sub", True)])
    assert have() == {"b.md"}
    (docs / "sub/c.md").unlink()
    indexer.index(str(docs))
    assert have() == {"sub/a.md", "b.md"}
    for f in docs.rglob("*"):
        if f.is_file():
            f.unlink()
    indexer.index(str(docs))
    assert have() == set()


def test_batches_hash_what_changed(spark, tmp_path, monkeypatch):
    docs = tmp_path / "docs"
    for i in range(5):
        put(docs, f"{i}.md", b"text %d" % i)
    indexer = TreeIndexer(spark, IndexStore(spark, str(tmp_path / "index")), stub_embedder)
    indexer.index(str(docs))
    seen = []
    real = doctree.hashed
    monkeypatch.setattr(doctree, "hashed", lambda listing, root: seen.append({r.rel_path for r in listing.collect()}) or real(listing, root))
    put(docs, "1.md", b"another text")
    put(docs, "new.md", b"new")
    indexer.index(str(docs), [Change("upsert", "new.md"), Change("upsert", "3.md")])
    assert seen == [{"1.md", "new.md", "3.md"}]
    assert {r.rel_path for r in indexer.hashes.read().collect()} == {"0.md", "1.md", "2.md", "3.md", "4.md", "new.md"}


@pytest.mark.parametrize("events", [True, False])
def test_changes_of_directories(tmp_path, events):
    for name in ("a.md", "d/b.md", "d/e/c.md", "x/y.md"):
        put(tmp_path, name, b"1")
    settings = config.load_settings(None, {"SOURCE__WATCH_PATH": str(tmp_path), "SOURCE__DEBOUNCE_SECONDS": "0.2"})
    watch, got = LocalWatch(settings.source, events=events), []
    watch.prepare()
    put(tmp_path, "early.md", b"between the first look and the start")
    watch.start(lambda changes: got.append({(c.op, c.path) for c in changes}))

    def after(n):
        end = time.time() + 15
        while len(got) < n and time.time() < end:
            time.sleep(0.02)
        return got[n - 1]

    try:
        assert after(1) == {("upsert", "early.md")}
        os.rename(tmp_path / "d", tmp_path / "z")
        put(tmp_path, "new/er/f.md", b"2")
        (tmp_path / "x/y.md").unlink()
        (tmp_path / "x").rmdir()
        assert after(2) == {("delete", "d/b.md"), ("delete", "d/e/c.md"), ("upsert", "z/b.md"), ("upsert", "z/e/c.md"), ("upsert", "new/er/f.md"), ("delete", "x/y.md")}
        put(tmp_path, "z/e/c.md", b"changed")
        put(tmp_path, "new/er/g.md", b"3")
        assert after(3) == {("upsert", "z/e/c.md"), ("upsert", "new/er/g.md")}
        time.sleep(0.6)
        assert len(got) == 3
    finally:
        watch.stop()


class Recorder:
    def __init__(self):
        self.calls = []

    def index(self, root, changes=None):
        self.calls.append(changes)
        return {}


def test_following_a_local_tree(tmp_path):
    put(tmp_path, "a.md", b"1")
    settings = config.load_settings(None, {"SOURCE__WATCH_PATH": str(tmp_path), "SOURCE__DEBOUNCE_SECONDS": "0.1"})
    indexer = Recorder()
    engine = Engine(settings, indexer=indexer, source=LocalWatch(settings.source), logs=False)
    import threading

    runner = threading.Thread(target=engine.run)
    runner.start()
    time.sleep(0.5)
    put(tmp_path, "b.md", b"2")
    (tmp_path / "a.md").unlink()
    end = time.time() + 10
    while len(indexer.calls) < 2 and time.time() < end:
        time.sleep(0.05)
    engine.stop()
    runner.join(10)
    assert indexer.calls[0] is None and {(c.op, c.path) for c in indexer.calls[1]} == {("delete", "a.md"), ("upsert", "b.md")}
    with pytest.raises(FileNotFoundError):
        Engine(config.load_settings(None, {"SOURCE__WATCH_PATH": "/nowhere/at/all"}), indexer=indexer, logs=False).reindex_once()


def test_following_events(spark, tmp_path):
    from siltmark.streaming.watch import event_stream, follow, sessions

    folder = tmp_path / "events"
    put(folder, "1.json", b'{"seq":1,"ts":"2024-01-01T00:00:00Z","event_type":"created","src_path":"/t/a","is_directory":false}\n{"seq":2,"ts":"2024-01-01T00:00:01Z","event_type":"deleted","src_path":"/t/a","is_directory":false}\n')
    seen = []
    query = follow(event_stream(spark, str(folder)), "/t", lambda changes: seen.extend(map(tuple, changes.collect())), str(tmp_path / "cp"), once=True)
    query.awaitTermination(60)
    assert seen == [(1, "delete", "a", False)]
    put(folder, "2.json", b'{"seq":3,"ts":"2024-01-01T00:10:00Z","event_type":"opened","src_path":"/t/a","is_directory":false}\n')
    out = sessions(event_stream(spark, str(folder)), "5 seconds").writeStream.format("memory").queryName("quiet").outputMode("append").trigger(availableNow=True).start()
    out.awaitTermination(60)
    assert [r.n for r in spark.sql("SELECT n FROM quiet").collect()] == [2]
