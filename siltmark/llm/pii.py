"""Personal data: patterns for protected entities, and terms that give them away.

An entity stands for several facts: its own value, and what it shares with others of its kind (the domain and the
name of a mail address, the networks of an IP address, the issuer of a card, the area of a phone number). How strongly a term reveals
a fact is estimated from co-occurrence in the whole corpus: PMI(term; fact) as a share of the fact's information
content, log(p * N / n_f) / log(N / n_f), where N counts documents, n_f those that hold the fact, and p is the chance that a
document with the term has it near the fact. A share of 1 means that whoever reads the term knows the fact.

p is a lower bound: n_tf / n_t, of documents with the term near the fact and documents with the term anywhere, times
m / (m + z^2), which is Wilson's lower bound (z standard errors) for an inference that held in all of m trials. m counts
the different texts that show the two together, so that copies of one text add no certainty.

A term's disclosure is the largest share over all facts. In documents that hold protected entities, terms from
``generalise`` on are replaced by their shape, from ``remove`` on they are removed; documents without entities have
nothing to protect and stay as they are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmark.llm._common import cut, parquet, small_batches

KINDS = ("email", "ip", "card", "phone")
WINDOW, Z, GENERALISE, REMOVE = 4, 1.0, 0.85, 0.95
#: Different terms that a task counts before it hands its counts on.
HELD = 500_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match never begins within a run of digits, as the run's first digit would do as well
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+(?:[-'][^\W_]+)*")


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards, so that long runs of characters without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        run = text[done:at]
        start = done + len(run.rstrip(_LOCAL))
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def digits_of(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)]
    if "." in text:
        found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = digits_of(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def facts(kind: str, text: str) -> list[str]:
    """Names of what an entity gives away, the same for all its spellings and no use to a reader: its value first, then what it shares with others."""
    if kind == "email":
        value = text.lower()
        local, _, domain = value.rpartition("@")
        name = re.match("[a-z]*", local)[0]
        known = [("", value), ("domain", domain), *([("name", name)] if name else [])]
    elif kind == "ip":
        parts = [x.lstrip("0") or "0" for x in text.split(".")]
        known = [("", ".".join(parts)), ("24", ".".join(parts[:3])), ("16", ".".join(parts[:2]))]
    else:
        digits = digits_of(text)
        known = [("", digits), ("issuer", digits[:6]) if kind == "card" else ("area", digits[:-7])]
    return [sha256(f"{kind}:{level}:{value}".encode("utf-8", "surrogatepass")).hexdigest()[:32] for level, value in known]


def all_terms(text: str) -> set[str]:
    """The different terms of a text in lower case, those within entities too."""
    if "\u0130" in text or "\u03a3" in text:  # their lower case depends on what surrounds them
        return set(map(str.lower, _TERM.findall(text)))
    return set(_TERM.findall(text.lower()))


def outer_terms(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, length, term in lower case) of the text's terms that no entity overlaps, in order; the spans are sorted by start."""
    out: list[tuple[int, int, str]] = []
    at, end = 0, 0  # the spans before at have begun before the term ends; the last of them to end does so at end
    for m in _TERM.finditer(text) if spans else ():
        while at < len(spans) and spans[at][0] < m.end():
            end = max(end, spans[at][1])
            at += 1
        if end <= m.start():
            out.append((m.start(), len(m[0]), m[0].lower()))
    return out


def seen_near(text: str, window: int) -> tuple[list, list[str], set[tuple[str, str]], list[str]]:
    """Of a text: its base spans, its different facts, the (fact, term) that stand within ``window`` terms of each other, and its different terms outside entities."""
    spans = base_spans(text)
    if not spans:
        return spans, [], set(), []
    terms = outer_terms(text, spans)
    starts, near, held = [at for at, _, _ in terms], set(), set()
    for a, b, kind in spans:
        at, own = bisect_left(starts, a), facts(kind, text[a:b])
        held.update(own)
        near |= {(f, t) for _, _, t in terms[max(0, at - window) : at + window] for f in own}
    return spans, sorted(held), near, sorted({t for _, _, t in terms})


_SPANS = "array<struct<kind string, start int, stop int>>"


def as_rows(spans) -> list[dict]:
    return [{"kind": k, "start": a, "stop": b} for a, b, k in spans]


def scanned(docs: DataFrame, id_col: str, text_col: str, window: int, with_text: bool) -> DataFrame:
    """Per input row: doc_id, row (a number of its own) and spans; where there are any, also text, digest, facts, near and terms. with_text gives text to all rows."""

    @F.pandas_udf(f"spans {_SPANS}, digest binary, facts array<string>, near array<struct<fact string, term string>>, terms array<string>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for x in batch:
                spans, held, near, terms = seen_near(x or "", window)
                if spans:
                    digest = sha256(x.encode("utf-8", "surrogatepass")).digest()[:16]
                    rows.append((as_rows(spans), digest, held, [{"fact": f, "term": t} for f, t in sorted(near)], terms))
                else:
                    rows.append(([], None, None, None, None))
            yield pd.DataFrame(rows, columns=["spans", "digest", "facts", "near", "terms"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), run(F.col(text_col)).alias("s")).select("doc_id", "text", "s.*")
    text = F.col("text") if with_text else F.when(F.size("spans") > 0, F.col("text"))
    return cut(own.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"), "spans", "digest", "facts", "near", "terms"))


def document_counts(docs: DataFrame, text_col: str, held: int = HELD) -> DataFrame:
    """(term, n_t): how many documents have each term. Each task adds up what it reads, and hands its counts on when it holds ``held`` of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        told = lambda: pd.DataFrame({"term": list(counts), "n": list(counts.values())}).astype({"term": object, "n": "int64"})
        for batch in batches:
            for x in batch["text"]:
                counts.update(all_terms(x or ""))
                if len(counts) > held:
                    yield told()
                    counts.clear()
        yield told()

    partial = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "term string, n long")
    return partial.groupBy("term").agg(F.sum("n").alias("n_t"))


def judged(found: DataFrame, docs: DataFrame, text_col: str, z: float, generalise: float, remove: float) -> DataFrame:
    """(term, disclosure, action) of the terms from ``generalise`` on; found is what scanned() gives for the docs."""
    n = F.lit(float(max(1, docs.count())))
    held = found.filter(F.size("spans") > 0)
    near = held.select("digest", F.explode("near").alias("x")).groupBy("x.fact", "x.term", "digest").count()
    near = near.groupBy("fact", "term").agg(F.count(F.lit(1)).alias("m"), F.sum("count").alias("n_tf"))
    n_f = held.select(F.explode("facts").alias("fact")).groupBy("fact").agg(F.count(F.lit(1)).alias("n_f"))
    told = near.join(n_f, "fact").filter(F.col("n_f") < n).join(document_counts(docs, text_col), "term")
    p = F.col("n_tf") / F.col("n_t") * F.col("m") / (F.col("m") + z * z)
    share = F.log(p * n / F.col("n_f")) / F.log(n / F.col("n_f"))
    found = told.groupBy("term").agg(F.max(share).alias("disclosure")).filter(F.col("disclosure") >= generalise)
    return found.withColumn("action", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise"))


def disclosures(docs: DataFrame, text_col: str = "text", window: int = WINDOW, z: float = Z, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(term, disclosure, action) of the terms that give a fact away; over all documents."""
    small_batches(docs.sparkSession)
    found = scanned(docs.select(F.lit(None).cast("long").alias("id"), F.col(text_col).alias("text")), "id", "text", window, False)
    return judged(found, docs, text_col, z, generalise, remove)


def shape(term: str) -> str:
    return "[NUMBER]" if term.isdigit() else "[NAME]" if term[:1].isupper() else "[TERM]"


def term_spans(text: str, spans: list, terms: dict[str, str]) -> list[tuple[int, int, str]]:
    """The spans of the given terms outside entities, their action as kind."""
    return [(a, a + n, terms[t]) for a, n, t in outer_terms(text, spans) if t in terms] if terms else []


def sanitised(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]" if kind in KINDS else "" if kind == "remove" else shape(text[a:b])]
            at = b
    return "".join([*out, text[at:]])


def with_terms(with_text: bool):
    """A function of (text, base spans, terms as a map to actions) that gives all spans by start, with_text also the sanitised text."""

    @F.pandas_udf(f"spans {_SPANS}" + ", sanitised string" * with_text)
    def run(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, bases, marks in columns:
            out, clean = [], []
            for x, base, terms in zip(texts, bases, marks, strict=True):
                base = [(s["start"], s["stop"], s["kind"]) for s in base]
                every = sorted(base + term_spans(x, base, dict(terms)), key=lambda s: s[0])
                out.append(as_rows(every))
                if with_text:
                    clean.append(sanitised(x, every))
            yield pd.DataFrame({"spans": out} | ({"sanitised": clean} if with_text else {}))

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, window: int = WINDOW, z: float = Z, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Per input row: doc_id (as it is, null or repeated) and spans (kind, start, stop; in code points, end exclusive, by start; kinds are KINDS, generalise and remove), with_text also the sanitised text (null for null).

    Null counts as empty; a text without entities has no spans and stays as it is. Equal rows get equal spans. An empty
    table gives no rows. The text is read twice, once for entities and once for counts; only texts with entities
    are kept meanwhile (with_text: all), and a term meets the documents that hold it by a join.
    """
    small_batches(docs.sparkSession)
    found = scanned(docs, id_col, text_col, window, with_text)
    told = judged(found, docs, text_col, z, generalise, remove)
    held, clean = found.filter(F.size("spans") > 0), found.filter(F.size("spans") == 0)
    marks = held.select("row", F.explode("terms").alias("term")).join(told, "term").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("marks"))
    marked = held.join(marks.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
    none = F.create_map().cast("map<string,string>")
    marked = marked.select("doc_id", with_terms(with_text)(F.col("text"), F.col("spans"), F.coalesce("marks", none)).alias("s")).select("doc_id", "s.*")
    return marked.unionByName(clean.select("doc_id", "spans", *([F.col("text").alias("sanitised")] if with_text else [])))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op9_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(parquet(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*KINDS))
    n = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in KINDS], (F.size(base) > 0).alias("has_pii"), F.sha2(span_list(base), 256).alias("base_sha256"), span_list(spans).alias("spans"))
