"""Quality rules as a short-circuit cascade.

Every rule is a Catalyst predicate that holds for a bad document. On a sample of bounded size each rule's cost
(seconds a row, less what an empty run takes) and selectivity (share of rows it rejects) are measured; rules run in falling
order of rejection per cost, as nested CASE branches, so that a document pays only for the rules up to its first
failure: measures are computed within the branches that ask for them, unless they are wanted as columns. The
order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmark.llm._common import BLANKS, count_of, cut, let, parquet, release, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows of the sample that costs and selectivities are measured on, and how often a measured run repeats them.
SAMPLE_ROWS, REPEATS = 1000, 3

#: Of the measures' columns, a predicate.
Rule = Callable[[Mapping[str, Column]], Column]


def repeated_words(words_: Column, n: int = WINDOW) -> Column:
    """How many words lie in n-word windows (n a power of 2) that occur twice or more in the array, first occurrences included.

    Windows are compared by hash first: a window's hash is made of the hashes of its halves, and so on down to words.
    Those whose hash recurs are compared as whole texts.
    """
    last = F.size(words_) - n

    def halves(h: Column, width: int) -> Column:
        """From the hashes of all windows of ``width`` words to those of twice as many; the ends of the array give windows that aren't there."""
        return h if width == n else let(h, lambda x: halves(F.zip_with(x, F.slice(x, F.lit(width + 1), F.greatest(F.size(x) - width, F.lit(0))), lambda a, b: F.xxhash64(a, b)), 2 * width))

    hashes = F.slice(halves(F.transform(words_, lambda w: F.xxhash64(w)), 1), F.lit(1), last + 1)

    def recurring(placed: Column) -> Column:
        """Of an array of (key, i) sorted by key, the i of those whose key a neighbour has too."""
        same = lambda a, x, j: F.coalesce(F.get(a, j - 1)["key"] == x["key"], F.lit(False)) | F.coalesce(F.get(a, j + 1)["key"] == x["key"], F.lit(False))
        return let(placed, lambda a: F.transform(F.filter(a, lambda x, j: same(a, x, j)), lambda x: x["i"]))

    def suspects(h: Column) -> Column:
        return recurring(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("key"), i.alias("i")))))

    def true_ones(at: Column) -> Column:
        gram = lambda i: F.array_join(F.slice(words_, i + 1, F.lit(n)), " ")
        return F.array_sort(recurring(F.array_sort(F.transform(at, lambda i: F.struct(gram(i).alias("key"), i.alias("i"))))))

    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(n), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    count = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(suspects(h), lambda s: let(true_ones(s), covered))))
    return F.when(last < 1, F.lit(0)).otherwise(count).cast("long")


def opened(docs: DataFrame, text_col: str) -> DataFrame:
    """Input rows as the struct ``row``, with text_ (null as empty) and words_, which all measures start from."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.struct(*docs.columns).alias("row"), text.alias("text_"), words(F.col(text_col)).alias("words_"))


def measures() -> dict[str, Column]:
    """The measures as expressions over the columns of opened(). A text without words has zeros."""
    text, words_ = F.col("text_"), F.col("words_")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return {
        "n_words": F.size(words_).cast("long"),
        "word_chars": F.char_length(text).cast("long") - count_of(text, BLANKS),
        "n_symbols": count_of(text, SYMBOLS),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": repeated_words(words_),
        "n_distinct": F.size(F.array_distinct(words_)).cast("long"),
        "n_upper": (F.char_length(text) - F.char_length(F.regexp_replace(text, r"\p{Lu}", ""))).cast("long"),
        "n_exclamations": count_of(text, "!"),
    }


#: What the contract of the query wants as columns.
SHOWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

RULES: dict[str, Rule] = {
    "few_words": lambda m: m["n_words"] < 20,
    "repeated_words": lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 30,
    "symbols": lambda m: m["n_symbols"] * 3 > m["n_words"],
    "word_length": lambda m: (m["word_chars"] < m["n_words"] * 2) | (m["word_chars"] > m["n_words"] * 25),
    "repeated_lines": lambda m: (m["n_dup_lines"] > 0) & (m["n_dup_lines"] * 2 > m["n_lines"]),
    "shouting": lambda m: m["n_upper"] * 10 > m["word_chars"] * 4,
    "exclamations": lambda m: m["n_exclamations"] * 4 > m["n_words"],
    # distinct words grow as the root of a text's length, so their square is held against it
    "few_distinct_words": lambda m: m["n_distinct"] * m["n_distinct"] < m["n_words"],
}


def measured(docs: DataFrame, text_col: str = "text", names=SHOWN) -> DataFrame:
    """Input rows as the struct ``row``, with text_, words_ and the named measures as columns."""
    every = measures()
    return opened(docs, text_col).select("row", "text_", "words_", *[every[n].alias(n) for n in names])


def rule_order(sample: DataFrame, rules: Mapping[str, Column], repeats: int = REPEATS) -> list[tuple[str, float, float]]:
    """(name, seconds a row, share rejected) of each rule on the sample, by falling rejection per cost; ties by name.

    A run goes over the sample ``repeats`` times, and the faster of two runs counts, less the faster run without any rule.
    """
    if not rules:
        return []
    again = sample.withColumn("again_", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def seconds(bad: Column) -> float:
        found = []
        for _ in range(2):
            began = time.perf_counter()
            again.agg(F.count_if(bad)).collect()
            found.append(time.perf_counter() - began)
        return min(found)

    n = max(1, sample.count())
    counts = sample.agg(*[F.count_if(c).alias(f"r{i}") for i, c in enumerate(rules.values())]).first()
    empty = seconds(F.size("words_") < 0)
    timed = [(name, max(1e-9, (seconds(bad) - empty) / (n * repeats)), counts[i] / n) for i, (name, bad) in enumerate(rules.items())]
    return sorted(timed, key=lambda x: (-x[2] / x[1], x[0]))


def passes(order: list[str], rules: Mapping[str, Column]) -> Column:
    """Whether no rule rejects the row; they are tried in this order, up to the first that does."""
    found = F.lit(True)
    for name in reversed(order):
        found = F.when(F.coalesce(rules[name], F.lit(False)), F.lit(False)).otherwise(found)
    return found


def quality_cascade(docs: DataFrame, text_col: str = "text", rules: Mapping[str, Rule] | None = None, shown=(), sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> DataFrame:
    """Input rows as the struct ``row``, with kept and the measures in ``shown`` as columns; these are computed for every row, all others only where a rule comes to ask for them.

    A rule that gives null doesn't reject. Null texts count as empty. The sample only decides the rules' order: every row is judged
    on its whole text. An empty table gives no rows.
    """
    known = measures() | {n: F.col(n) for n in shown}
    found = {name: rule(known) for name, rule in (RULES if rules is None else rules).items()}
    share = min(1.0, 2 * sample_rows / max(1, docs.count()))
    sample = cut(measured(docs.sample(False, share, seed).limit(sample_rows), text_col, shown))
    order = [name for name, _, _ in rule_order(sample, found)]
    release(sample)
    return measured(docs, text_col, shown).select("row", *shown, passes(order, found).alias("kept"))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = quality_cascade(parquet(spark, sf_dir, "documents").select("doc_id", "text"), shown=SHOWN)
    base = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (F.col("kept") & ~base).alias("kept"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT k, i, hash(list_slice(w, i + 1, i + 8)) AS h, list_slice(w, i + 1, i + 8) AS g FROM (SELECT k, w, unnest(range(len(w) - 7)) AS i FROM w WHERE len(w) >= 8)),
f AS (SELECT k, i FROM (SELECT *, count(*) OVER (PARTITION BY k, h, g) AS c FROM g) WHERE c > 1),
r AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest(range(i, i + 8)) AS j FROM f) GROUP BY k),
m AS (SELECT doc_id, t, w, ls, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r USING (k)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 3 > n_words OR word_chars < n_words * 2 OR word_chars > n_words * 25 OR n_dup_lines * 2 > len(ls)
    OR (length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g'))) * 10 > word_chars * 4 OR (length(t) - length(replace(t, '!', ''))) * 4 > n_words
    OR len(list_distinct(w)) * len(list_distinct(w)) < n_words) AS kept
FROM v
"""
