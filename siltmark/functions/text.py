"""Text functions as Catalyst expressions: nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, and the four separators that count as such in plain text: what strip() takes off.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without white space at both ends, in time that is linear in the text."""
    return F.btrim(text, F.lit(BLANKS))


def is_useful(text: Column) -> Column:
    """A letter or digit is left once tags are gone."""
    return F.regexp_replace(text, "<[^>]+>", " ").rlike(r"[\p{L}\p{N}]")


def token_count(text: Column) -> Column:
    """Without a tokenizer: a token for every four characters, rounded up, at least one."""
    return F.greatest(F.lit(1), F.expr("0") + F.floor((F.char_length(text) + 3) / 4).cast("int"))


def char_windows(text: Column, size: int = 1200, overlap: int = 150) -> Column:
    """Windows of ``size`` characters, each beginning ``size - overlap`` after the last, the last one reaching the end; stripped, without empty ones."""
    if size <= 0:
        raise ValueError("size must be positive")
    if overlap < 0:
        raise ValueError("overlap must not be negative")
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")
    t = strip(F.regexp_replace(text, "\r\n?", "\n"))
    return let(t, lambda t: _windows(t, size, overlap))


def _windows(t: Column, size: int, overlap: int) -> Column:
    n, step = F.char_length(t), size - overlap
    cuts = F.transform(F.sequence(F.lit(0), F.ceil((n - size) / step).cast("int")), lambda k: strip(F.substring(t, (k * step + 1).cast("int"), F.lit(size))))
    empty = F.array().cast("array<string>")
    return F.when(n == 0, empty).when(n <= size, F.array(t)).otherwise(F.filter(cuts, lambda w: w != ""))


def let(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def split_limits(max_tokens: int) -> tuple[int, int]:
    size = max(64, 4 * max_tokens)
    return size, min(150, max(0, size // 6))


def hard_split(text: Column, max_tokens: int) -> Column:
    return char_windows(text, *split_limits(max_tokens))


_RUN = "struct<first:int,n:int,split:boolean>"
_STATE = f"struct<out:array<{_RUN}>,first:int,n:int,len:int>"


def pack(parts: Column, sep: Column, max_tokens: int, split_part) -> Column:
    """Greedy packing in order: parts are joined while the joined text fits; a part that alone is over the budget is split by split_part.

    parts and sep are to be cheap to evaluate (lambda variables, say). The fold carries lengths and places alone, so that a
    text is joined once, when its run is complete.
    """
    tokens = lambda n: F.greatest(F.lit(1), F.floor((n + 3) / 4).cast("int"))
    state = lambda out, first, n, len_: F.struct(out.alias("out"), first.alias("first"), n.alias("n"), len_.alias("len")).cast(_STATE)
    run = lambda first, n, split: F.struct(first.alias("first"), n.alias("n"), F.lit(split).alias("split")).cast(_RUN)
    none, zero, one = F.array().cast(f"array<{_RUN}>"), F.lit(0), F.lit(1)
    flushed = lambda a: F.when(a["n"] > 0, F.array_append(a["out"], run(a["first"], a["n"], False))).otherwise(a["out"])

    def step(gap: Column):
        def take(a: Column, p: Column) -> Column:
            joined = a["len"] + gap + p["len"]
            return (
                F.when(tokens(p["len"]) > max_tokens, state(F.array_append(flushed(a), run(p["i"], one, True)), zero, zero, zero))
                .when(a["n"] == 0, state(a["out"], p["i"], one, p["len"]))
                .when(tokens(joined) > max_tokens, state(flushed(a), p["i"], one, p["len"]))
                .otherwise(state(a["out"], a["first"], a["n"] + 1, joined))
            )

        return take

    sizes = F.transform(parts, lambda p, i: F.struct(F.char_length(p).alias("len"), i.alias("i")))
    runs = let(F.char_length(sep), lambda gap: F.aggregate(sizes, state(none, zero, zero, zero), step(gap), flushed))
    joined = lambda r: F.call_function("array_join", F.slice(parts, r["first"] + 1, r["n"]), sep)
    return F.flatten(F.transform(runs, lambda r: F.when(r["split"], split_part(F.get(parts, r["first"]))).otherwise(F.array(joined(r)))))


def split_prose(text: Column, max_tokens: int) -> Column:
    """Paragraphs, or lines where there are none, packed to the budget."""
    gap = lambda t: F.when(F.contains(t, F.lit("\n\n")), F.lit("\n\n")).otherwise(F.lit("\n"))
    parts = lambda t, sep: F.filter(F.transform(F.split(t, sep), strip), lambda p: p != "")
    packed = lambda t, sep, ps: F.when(F.size(ps) <= 1, hard_split(t, max_tokens)).otherwise(pack(ps, sep, max_tokens, lambda p: hard_split(p, max_tokens)))
    return let(text, lambda t: let(gap(t), lambda sep: let(parts(t, sep), lambda ps: packed(t, sep, ps))))


def fold(text: Column) -> Column:
    """Case folding for what occurs in practice: lower case, and the letters that fold to others."""
    return F.translate(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), "ſµς", "sμσ")


def normalized(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(fold(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), " ")


def picture_block(description: Column, caption: Column) -> Column:
    d, c = strip(F.coalesce(description, F.lit(""))), strip(F.coalesce(caption, F.lit("")))
    body = F.concat(F.lit("[Изображение]\nОписание: "), d, F.when(c != "", F.concat(F.lit("\nПодпись: "), c)).otherwise(F.lit("")))
    return F.when(d == "", F.lit("")).otherwise(body)


def picture_description(annotations: Column, meta_text: Column, meta_string: Column) -> Column:
    """The first that isn't blank: of each annotation text, then description; then the two of the metadata."""
    candidates = F.concat(F.flatten(F.transform(F.coalesce(annotations, F.expr("array()").cast("array<struct<text:string,description:string>>")), lambda a: F.array(a["text"], a["description"]))), F.array(meta_text, meta_string))
    stripped = F.filter(F.transform(candidates, lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != "")
    return F.coalesce(F.get(stripped, 0), F.lit(""))


def json_content_length(body: Column) -> Column:
    """Characters of choices[0].message.content of a chat response; 0 on any trouble."""
    return F.coalesce(F.char_length(F.get_json_object(body, "$.choices[0].message.content")), F.lit(0))
