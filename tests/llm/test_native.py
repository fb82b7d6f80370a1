"""Exact dedup, mixing and quality rules against plain Python."""

import re
import unicodedata
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from siltmark.llm.exact_dedup import content_sort_dedup, range_of, splitters
from siltmark.llm.mixing import mix_sources, mixed_documents
from siltmark.llm.quality_rules import SHOWN, measured, measures, passes, quality_cascade, rule_order

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("copies", [0, 60, 300])
@pytest.mark.parametrize("ranges", [1, 4, 30, 200])
def test_exact_dedup(spark, docs, rows, keep, copies, ranges):
    """Without and with groups that are longer than a range; one of them has no identifiers."""
    more = [(500 + i % 50, "Hot text" if i % 2 else "hot text", f"s{i % 7}", "en") for i in range(copies)]
    more += [(None, "other " * 100, f"s{i % 40}", "en") for i in range(copies // 2)] + [(900 + i, "other " * 100 + str(i % 3), "s", "en") for i in range(copies // 2)]
    df = docs
    if more:
        df = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, source string, lang string"), allowMissingColumns=True)
    groups = defaultdict(list)
    for r in [*rows, *more]:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    best = min if keep == "min" else max
    want, kept = Counter(), Counter()
    for norm, ids in groups.items():
        keep_id = best([i for i in ids if i is not None], default=None)
        kept[keep_id] += 1
        for i in ids:
            want[(i, keep_id, len(ids), sha256(norm.encode()).hexdigest())] += 1
    found = content_sort_dedup(df, keep=keep, ranges=ranges).cache()
    assert count(found, F.col("row.doc_id"), "keep_id", "group_size", "text_sha256") == want
    assert Counter(r[0] for r in found.filter("kept").select("row.doc_id").collect()) == kept
    assert set(found.select("row.*").columns) == set(df.columns)


def test_splitters():
    places = [f"a\0{i:03}\0x" for i in range(100)] + [f"m\0000\0{i:03}" for i in range(400)] + [f"z\0{i:03}\0x" for i in range(100)]
    bounds, shared = splitters(places, 12)
    assert shared == ["m\0000\0"] and len(bounds) == 11 and sum(b.startswith("m") for b in bounds) == 8
    assert all(b.endswith("\0") for b in bounds if not b.startswith("m"))
    assert splitters([], 5) == ([], []) and splitters(places, 1) == ([], [])


@pytest.mark.parametrize("n", [0, 1, 2, 10, 211])
def test_range_of(spark, n):
    bounds = sorted({f"{i * 37 % 1000:03}" for i in range(n)})
    df = spark.range(1000).select(F.format_string("%03d", "id").alias("place"))
    assert all(r.at == sum(b <= r.place for b in bounds) for r in df.withColumn("at", range_of(F.col("place"), bounds)).collect())


def test_empty_tables(empty):
    assert content_sort_dedup(empty).count() == 0
    assert mix_sources(empty).count() == 0
    assert mixed_documents(empty).count() == 0
    assert quality_cascade(empty).count() == 0


def filled(sizes, weights, share, most):
    """Targets by dealing out again and again."""
    total, left, target = share * sum(sizes.values()), dict(zip(sizes, weights, strict=True)), {}
    while left:
        rest, w = total - sum(target.values()), sum(left.values())
        over = [s for s in left if rest * left[s] / w > most * sizes[s] + 1e-9]
        if not over:
            return target | {s: rest * left[s] / w for s in left}
        for s in over:
            target[s] = most * sizes[s]
            del left[s]
    return target


def test_mixing(spark, docs, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len(WORD.findall(r[1] or ""))
    sizes = {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}
    want = filled(sizes, [3, 1, 2, 3][: len(sizes)], 1.5, 2)
    found = mix_sources(docs).select("row.source", "size", "source_size", "target", "taken", "row.doc_id").collect()
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = count(mix_sources(docs.repartition(7)), "row.doc_id", "taken")
    assert again == count(mix_sources(docs), "row.doc_id", "taken")
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    out = defaultdict(int)
    for r in mixed.select("source", "text").collect():
        out[r.source] += len(WORD.findall(r.text))
    assert dict(out) == {s: n for s, n in taken.items() if n}


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    inside = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_quality_measures(spark, docs, rows):
    more = ["a b c d e f g h " * 3, "x\nx\n\nx\ny z", "# * | <b> &", "a " * 7, "a " * 9, "q r s t u v w x y q r s t u v w x y z q r s t u v w x"]
    df = docs.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = Counter((i, *plain_measures(t)) for i, t in [(r[0], r[1]) for r in rows] + [(1000 + i, t) for i, t in enumerate(more)])
    assert count(measured(df), F.col("row.doc_id"), *names) == want


def test_cascade_verdict_is_order_free(docs):
    rules = {"short": lambda m: m["n_words"] < 20, "symbols": lambda m: m["n_symbols"] > 2, "never": lambda m: F.lit(None).cast("boolean")}
    want = Counter((r[0],) for r in measured(docs).filter("n_words >= 20 AND n_symbols <= 2").select("row.doc_id").collect())
    for shown in ((), ("n_words", "n_repeat_words")):
        found = quality_cascade(docs, rules=rules, shown=shown)
        assert found.columns == ["row", *shown, "kept"] and count(found.filter("kept"), F.col("row.doc_id")) == want
    sample = measured(docs.select("doc_id", "text"))
    found = {name: rule(measures()) for name, rule in rules.items()}
    order = rule_order(sample, found)
    assert {x[0] for x in order} == set(rules) and order[0][0] == "short"  # the others reject nothing here
    assert all(sample.select(passes(list(o), found).alias("ok")).filter("ok").count() == sum(want.values()) for o in permutations(rules))


def plain_verdict(text):
    """All rules on one text, from their descriptions."""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat = plain_measures(text)
    text, lines = text or "", [x for x in (text or "").split("\n") if WORD.search(x)]
    upper, distinct = sum(unicodedata.category(c) == "Lu" for c in text), len(set(WORD.findall(text)))
    bad = [n_words < 20, n_repeat * 100 > n_words * 30, n_symbols * 3 > n_words, word_chars < 2 * n_words or word_chars > 25 * n_words, n_dup_lines * 2 > len(lines), upper > 0.4 * word_chars, text.count("!") * 4 > n_words, distinct**2 < n_words]
    return not any(bad)


def test_verdicts(spark, docs, rows):
    more = ["one two three four five six seven eight nine ten " * 2 + "a b", "AB CD " * 3 + " ".join(f"X{i}Y" for i in range(30)), " ".join(f"w{i}!" for i in range(30)), " ".join(f"w{i % 5}" for i in range(40)), " ".join(f"w{i * i % 41}x" for i in range(40)), "\n".join(["same line of words"] * 9), " ".join("x" * 30 + str(i) for i in range(25))]
    df = docs.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    want = Counter((i, plain_verdict(t)) for i, t in [(r[0], r[1]) for r in rows] + [(1000 + i, t) for i, t in enumerate(more)])
    assert count(quality_cascade(df), F.col("row.doc_id"), "kept") == want
    assert count(quality_cascade(df, shown=SHOWN), F.col("row.doc_id"), "kept") == want
    assert {k for _, k in want} == {True, False}
