"""The engine: a full reconcile, incremental batches, and following a source."""

from __future__ import annotations

import logging
import os
import signal
import threading
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmark.config import LocalSource, Settings, load_settings
from siltmark.embedder import HttpEmbedder
from siltmark.functions.paths import indexable, resolve_extensions
from siltmark.functions.tokenized import Counter, FileCounter
from siltmark.operators.changes import apply_changes
from siltmark.operators.chunking import assemble_chunks, merge_peers
from siltmark.operators.embedding import embed_chunks, points, python_embedder
from siltmark.operators.reconcile import indexed_paths, reconcile
from siltmark.operators.store import HashStore, IndexStore
from siltmark.schema import CHANGES
from siltmark.session import session
from siltmark.sources import doctree
from siltmark.sources.inotify import Watcher
from siltmark.sources.pictures import HttpDescriber, PictureOptions
from siltmark.sources.readers import read_documents
from siltmark.sources.remote import Change, SmbRemote, StagedSource

log = logging.getLogger(__name__)


def configure_logging(level: str = "INFO") -> None:
    number = logging.getLevelNamesMapping().get(level.upper(), logging.INFO)
    logging.basicConfig(level=number, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.DEBUG if number <= logging.DEBUG else logging.WARNING)


class TreeIndexer:
    """Keeps an index in step with a tree; index(root) reconciles all of it, index(root, changes) a batch.

    A full reconcile hashes every file; a batch hashes the files that it names and those that changed in size or time since
    they were last hashed. Either reads the files that it upserts, each once.
    """

    def __init__(self, spark: SparkSession, store: IndexStore, embedder: Callable[[Column], Column], allowed=(), max_tokens: int = 1024, tokenizer: Counter | None = None, pictures: PictureOptions | None = None, keep_versions: int = 2):
        self.spark, self.store, self.embedder, self.allowed, self.max_tokens = spark, store, embedder, tuple(sorted(allowed)), max_tokens
        self.tokenizer, self.pictures, self.keep_versions = tokenizer, pictures, keep_versions
        self.hashes = HashStore(spark, f"{store.folder}/hashes")
        doctree.register(spark)

    def tree(self, root: str) -> DataFrame:
        """(rel_path, size, mtime) of the files."""
        return self.spark.read.format("doctree").option("extensions", ",".join(self.allowed)).load(root).drop("content")

    def hashed(self, root: str, changes: DataFrame | None) -> DataFrame:
        """(rel_path, size, mtime, file_hash) of the files, as it is kept for the next batch."""
        listing = self.tree(root)
        if changes is None:
            return self.hashes.write(doctree.hashed(listing, root))
        listing = listing.persist()  # one look at the tree
        named = changes.filter("NOT is_prefix").select(F.col("path").alias("rel_path")).distinct()
        known = self.hashes.read().join(named, "rel_path", "left_anti")
        same = listing.join(known, ["rel_path", "size", "mtime"]).select("rel_path", "size", "mtime", "file_hash")
        fresh = listing.join(known, ["rel_path", "size", "mtime"], "left_anti")
        kept = self.hashes.write(same.unionByName(doctree.hashed(fresh, root)))
        listing.unpersist()
        return kept

    def _commit(self, root: str, upserted: DataFrame, removed: DataFrame) -> int:
        """What the steps make is written beside the index and read again, so that no file is parsed and no text embedded twice, whatever executors are lost."""
        folder, n = f"{self.store.folder}/scratch/{uuid.uuid4().hex}", 0

        def saved(df: DataFrame) -> DataFrame:
            nonlocal n
            n += 1
            df.write.parquet(f"{folder}/{n}")
            return self.spark.read.schema(df.schema).parquet(f"{folder}/{n}")

        try:
            hashes = saved(upserted.select("rel_path", "file_hash"))
            items = saved(read_documents(doctree.with_content(hashes.select("rel_path"), root), self.pictures))
            good = saved(merge_peers(items.filter("error IS NULL"), self.max_tokens))
            chunks = saved(assemble_chunks(good, self.max_tokens, tokenizer=self.tokenizer))
            embedded = saved(embed_chunks(chunks.filter("error IS NULL").join(hashes, "rel_path"), self.embedder))
            # files that failed keep what they had
            failed = items.filter("error IS NOT NULL").select("rel_path").union(chunks.filter("error IS NOT NULL").select("rel_path")).union(embedded.filter("failed").select("rel_path")).distinct()
            done = hashes.select("rel_path").join(failed, "rel_path", "left_anti")
            touched = saved(done.union(removed.select("rel_path")).select(F.col("rel_path").alias("source_path")))
            version = self.store.replace(touched, saved(points(embedded)))
            self.store.vacuum(self.keep_versions)
            return version
        finally:
            self.store.drop(folder)

    def index(self, root: str, changes: Sequence[Change] | DataFrame | None = None) -> dict[str, int]:
        """Counts by action. Without changes all is reconciled; no changes at all are nothing to do."""
        if isinstance(changes, Sequence):
            if not changes:
                return {}
            rows = [(i, c.op, c.path, c.is_prefix) for i, c in enumerate(changes)]
            changes = self.spark.createDataFrame(rows, CHANGES)
        disk = self.hashed(root, changes).filter(indexable(F.col("rel_path"), self.allowed)).select("rel_path", "file_hash")
        indexed = indexed_paths(self.store.read())
        if changes is None:
            plan = reconcile(disk, indexed).persist()
            gone = plan.filter(F.col("action").isin("stale_removed", "dup_removed"))
        else:
            plan = apply_changes(changes, disk, indexed, self.allowed).withColumnRenamed("source_path", "rel_path").persist()
            gone = plan.filter("action = 'deleted'")
        counts = {r.action: r["count"] for r in plan.groupBy("action").count().collect()}  # a row for each action
        if {"upserted", "stale_removed", "dup_removed", "deleted"} & counts.keys():
            self._commit(root, plan.filter("action = 'upserted'").select("rel_path", "file_hash"), gone)
        plan.unpersist()
        return counts


class LocalWatch:
    """Follows a local tree by the kernel's events, or by looking at all of it where there are none.

    Events only name the directories to look into: what changed is told by the size and time of their files. A batch
    is handed on when a whole period was quiet; what changes meanwhile waits for the next.
    """

    def __init__(self, settings: LocalSource, allowed=(), events: bool = True):
        self.settings, self.allowed, self.events = settings, allowed, events
        self._stop, self._thread = threading.Event(), None
        self._seen: dict[str, dict[str, tuple[int, float]]] = {}  # directory -> file's name -> size and time

    def prepare(self) -> str:
        if not os.path.isdir(self.settings.watch_path):
            raise FileNotFoundError(f"watch_path does not exist: {self.settings.watch_path}")
        self._seen = self._look("")
        return self.settings.watch_path

    def _look(self, top: str, deep: bool = True) -> dict[str, dict[str, tuple[int, float]]]:
        """What is in a directory, and below it if asked for; nothing if it is gone."""
        found, todo = {}, [top]
        while todo:
            at = todo.pop()
            try:
                entries = list(os.scandir(os.path.join(self.settings.watch_path, at) if at else self.settings.watch_path))
            except OSError:
                continue
            files = found[at] = {}
            for e in entries:
                try:
                    if e.is_dir(follow_symlinks=False):
                        if deep:
                            todo.append(f"{at}/{e.name}" if at else e.name)
                    elif e.is_file():
                        files[e.name] = (e.stat().st_size, e.stat().st_mtime)
                except OSError:
                    continue
        return found

    def changes(self, dirty: set[str] | None = None) -> list[Change]:
        """Since the last look; in the given directories, or anywhere."""
        if dirty is None:
            before, now = self._seen, self._look("")
            self._seen = now
        else:
            now = {}
            for top in dirty:
                now |= self._look(top, deep=False)
            gone = [d for d in self._seen if any(d == t or d.startswith(t + "/") for t in dirty - now.keys())]
            for top in dirty & now.keys():  # what is below may have gone without a word
                prefix = f"{top}/" if top else ""
                gone += [d for d in self._seen if d not in now and d.startswith(prefix) and d != top and not os.path.isdir(os.path.join(self.settings.watch_path, d))]
            before = {d: self._seen[d] for d in {*gone, *now} if d in self._seen}
            for d in gone:
                self._seen.pop(d, None)
            self._seen |= now
        flat = lambda tree: {f"{d}/{n}" if d else n: x for d, files in tree.items() for n, x in files.items()}
        old, new = flat(before), flat(now)
        return [Change("delete", p) for p in sorted(old.keys() - new.keys())] + [Change("upsert", p) for p in sorted(new) if old.get(p) != new[p]]

    def start(self, on_changes: Callable[[list[Change]], None]) -> None:
        quiet = max(0.05, self.settings.debounce_seconds)
        watcher = None
        if self.events:
            try:
                watcher = Watcher(self.settings.watch_path)
            except OSError as error:
                log.warning("no file events (%s); the tree is looked at every %s s", error, quiet)

        def by_events():
            first = self.changes()  # since prepare()
            held: dict[str, Change] = {c.path: c for c in first}
            dirty: set[str] | None = set()
            while not self._stop.is_set():
                fresh = watcher.wait(quiet)
                if fresh is None or dirty is None:
                    dirty = None
                else:
                    dirty |= fresh
                if (fresh is None or fresh) or not (held or dirty is None or dirty):
                    continue
                held |= {c.path: c for c in self.changes(dirty)}  # a whole period without events
                dirty = set()
                if held:
                    on_changes(list(held.values()))
                    held = {}

        def by_looks():
            held: dict[str, Change] = {}
            while not self._stop.wait(quiet):
                fresh = self.changes()
                held |= {c.path: c for c in fresh}
                if held and not fresh:
                    on_changes(list(held.values()))
                    held = {}

        def loop():
            try:
                (by_events if watcher else by_looks)()
            finally:
                if watcher:
                    watcher.close()

        self._stop.clear()
        self._thread = threading.Thread(target=loop, daemon=True)
        self._thread.start()

    def stop(self) -> None:
        self._stop.set()
        if self._thread:
            self._thread.join(35)


def build_indexer(settings: Settings, spark: SparkSession) -> TreeIndexer:
    m = settings.models
    embed = python_embedder(HttpEmbedder(m.base_url, m.embedding_model, m.embedding_timeout_sec))
    describer = HttpDescriber(m.base_url, m.vlm_model, m.vlm_prompt, m.vlm_timeout_sec) if m.picture_description_enabled else None
    pictures = PictureOptions(describer, m.picture_area_threshold, m.vlm_concurrency)
    tokenizer = FileCounter(m.tokenizer) if m.tokenizer else None
    store = IndexStore(spark, f"{settings.index.path.rstrip('/')}/{settings.index.collection}")
    return TreeIndexer(spark, store, embed, resolve_extensions(settings.index_extensions), m.chunk_size, tokenizer, pictures)


def build_source(settings: Settings):
    s, allowed = settings.source, resolve_extensions(settings.index_extensions)
    if isinstance(s, LocalSource):
        return LocalWatch(s, allowed)
    remote = SmbRemote(s.server, s.share, s.subpath, s.username, s.password.get_secret_value(), s.domain, s.port, s.timeout_sec)
    return StagedSource(remote, s.staging_path, allowed, s.poll_interval_sec, s.max_backoff_sec, s.timeout_sec)


class Engine:
    """reindex_once(), or run() until stop()."""

    def __init__(self, settings: Settings | None = None, spark: SparkSession | None = None, indexer=None, source=None, logs: bool = True):
        self.settings = settings or load_settings()
        if logs:
            configure_logging(self.settings.log_level)
        self.indexer = indexer or build_indexer(self.settings, spark or session())
        self.source = source or build_source(self.settings)
        self._stop = threading.Event()

    def reindex_once(self) -> dict[str, int]:
        return self.indexer.index(str(self.source.prepare()))

    def _prepared(self) -> str:
        """The root, tried again with growing pauses; a missing path is final."""
        pause, most = 1.0, getattr(self.settings.source, "max_backoff_sec", 60.0)
        while not self._stop.is_set():
            try:
                return str(self.source.prepare())
            except FileNotFoundError:
                raise
            except Exception:
                pause = min(most, pause * 2)
                log.exception("the source is not ready; the next try is in %s s", pause)
                self._stop.wait(pause)
        raise RuntimeError("stopped before the source was ready")

    def run(self) -> None:
        if threading.current_thread() is threading.main_thread():
            for name in (signal.SIGINT, signal.SIGTERM):
                signal.signal(name, lambda *_: self.stop())
        root = self._prepared()
        self.indexer.index(root)

        def apply(changes: list[Change]) -> None:
            try:
                self.indexer.index(root, changes)
            except Exception:
                log.exception("a batch of %s changes was not applied", len(changes))

        self.source.start(apply)
        try:
            while not self._stop.is_set():
                time.sleep(0.2)
        finally:
            self.source.stop()

    def stop(self) -> None:
        self._stop.set()


def reindex_once(settings: Settings | None = None) -> dict[str, int]:
    return Engine(settings).reindex_once()


def run(settings: Settings | None = None) -> None:
    Engine(settings).run()
