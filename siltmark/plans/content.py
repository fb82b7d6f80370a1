"""Queries over text, tables, chunks, vectors and points, with their SQL.

The tables hold no Markdown tables, so these are rendered: one of its customers for each nation, between a line of prose
and another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltmark.functions import tables as tb
from siltmark.functions import text as tx
from siltmark.functions.ids import fallback_ref
from siltmark.functions.vectors import stub_vector, vector_mean
from siltmark.operators import chunking as ck
from siltmark.operators import embedding as em
from siltmark.operators import reconcile as rc
from siltmark.plans.core import _FILES, files, point_id_sql, table
from siltmark.schema import INDEX_VERSION

BUDGET = 64


def docs(s, d) -> DataFrame:
    return table(s, d, "documents").select("doc_id", "text")


def pieces(df: DataFrame, array) -> DataFrame:
    return df.select("doc_id", F.posexplode(array).alias("pos", "piece"))


def markdown(s, d) -> DataFrame:
    """(n_nationkey, n_name, md): rows in the order of their keys."""
    rows = table(s, d, "customer").select("c_nationkey", F.struct("c_custkey", F.concat(F.lit("| "), F.col("c_custkey").cast("string"), F.lit(" | "), F.col("c_name"), F.lit(" |")).alias("row")).alias("r"))
    body = rows.groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"]), "\n").alias("body"))
    named = table(s, d, "nation").join(body, F.col("n_nationkey") == F.col("c_nationkey"))
    return named.select("n_nationkey", "n_name", F.concat(F.lit("| key | name |\n|---|---|\n"), "body").alias("md"))


def rendered(s, d) -> DataFrame:
    return markdown(s, d).select("n_nationkey", "md", F.concat(F.lit("Customers of "), "n_name", F.lit("\n"), "md", F.lit("\n\nEnd.")).alias("text"))


def table_lines(s, d) -> DataFrame:
    """(n_nationkey, pos, line) of the rendered texts."""
    return rendered(s, d).select("n_nationkey", F.posexplode(tb.lines(F.col("text"))).alias("pos", "line"))


def md_table_spans(lines: DataFrame, key: str = "n_nationkey") -> DataFrame:
    """(key, first, last) line numbers of each pipe table, by islands of rows and separators: a table runs from the island's first row that a separator follows to the island's end."""
    order = Window.partitionBy(key).orderBy("pos")
    flagged = lines.withColumn("r", tb.is_row(F.col("line"))).withColumn("s", tb.is_separator(F.col("line")))
    flagged = flagged.withColumn("island", F.sum((~F.col("r") & ~F.col("s")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    flagged = flagged.withColumn("opens", F.col("r") & ~F.col("s") & F.coalesce(F.lead("s").over(order), F.lit(False)))
    found = flagged.filter("r OR s").groupBy(key, "island").agg(F.min(F.when(F.col("opens"), F.col("pos"))).alias("first"), F.max("pos").alias("last"))
    return found.filter("first IS NOT NULL").select(key, "first", "last")


def items(s, d) -> DataFrame:
    """Each nation is a document: a heading with prose, its table twice, prose after it, and a stretch that repeats a part of the table."""
    base = markdown(s, d)
    item = lambda raw, ord_, kind, ref, text, caption=None: F.struct(F.lit(raw).alias("raw"), F.lit(ord_).alias("ord"), F.lit(kind).alias("kind"), F.lit(ref).alias("self_ref"), text.alias("text"), F.lit(caption).cast("string").alias("caption"))
    name, md = F.col("n_name"), F.col("md")
    every = F.array(
        item(0, 0, "prose", "#/t/0", F.concat(F.lit("Customers of "), name)), item(0, 1, "table", "#/tables/0", md, "Customers"), item(0, 2, "prose", "#/t/1", F.lit("End of table.")),
        item(1, 0, "table", "#/tables/0", md, "Customers"), item(1, 1, "prose", "#/t/1", F.lit("End of table.")), item(2, 0, "prose", "#/t/2", F.lit("| key |")), item(3, 0, "prose", "#/t/3", F.concat(F.lit("More of "), name)),
    )
    return base.select(F.col("n_name").alias("rel_path"), F.explode(every).alias("i")).select("rel_path", "i.raw", "i.ord", "i.kind", "i.self_ref", F.array(F.lit("Part"), F.lit("")).alias("headings"), "i.text", "i.caption")


def registry(s, d) -> DataFrame:
    base = markdown(s, d)
    shown = base.select(F.col("n_name").alias("rel_path"), F.lit("#/tables/0").alias("ref"), F.col("md").alias("text"), F.lit("Customers").alias("caption"))
    hidden = base.filter("n_nationkey < 5").select(F.col("n_name").alias("rel_path"), F.lit("#/tables/1").alias("ref"), F.lit("| a | b |\n|---|---|\n| 1 | 2 |").alias("text"), F.lit(None).cast("string").alias("caption"))
    return shown.union(hidden)


def assembled(s, d) -> DataFrame:
    return ck.assemble_chunks(items(s, d), 1 << 20, registry(s, d))


SHAPES = ("ruled", "bare", "one dash", "html", "broken")


def shapes(s, d) -> DataFrame:
    """(n_nationkey, md): tables of one to six columns with up to five rows; with a separator, without, with one that is none, as HTML, and with a line of prose in the header's place."""
    key = F.col("n_nationkey")
    first = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) <= 5
    cells = F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment", F.col("c_nationkey").cast("string"), F.lit("x"), F.upper("c_name"))
    rows = table(s, d, "customer").withColumn("first", first).filter("first").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", cells.alias("cells")))).alias("rs"))
    df = table(s, d, "nation").join(rows, key == F.col("c_nationkey")).withColumn("c", key % 6 + 1)
    line = lambda xs: F.concat(F.lit("| "), F.array_join(F.slice(xs, F.lit(1), F.col("c")), " | "), F.lit(" |"))
    head, body = line(F.array(*[F.lit(f"h{i}") for i in range(6)])), F.transform("rs", lambda r: line(r["cells"]))
    rule = lambda mark: F.concat(F.lit("|"), F.repeat(F.lit(mark + "|"), F.col("c")))
    tags = F.transform("rs", lambda r: F.concat(F.lit("<tr><td>"), F.array_join(F.slice(r["cells"], F.lit(1), F.col("c")), "</td><td>"), F.lit("</td></tr>")))
    every = [F.concat(F.array(head, rule(":--:")), body), F.concat(F.array(head), body), F.concat(F.array(head, rule("-")), body), F.concat(F.array(F.lit("<table>")), tags, F.array(F.lit("</table>"))), F.concat(F.array(head, F.lit("note"), rule("---")), body)]
    md = F.element_at(F.array(*[F.array_join(x, "\n") for x in every]), (key % 5 + 1).cast("int"))
    return df.select("n_nationkey", md.alias("md"))


def table_shapes(s, d) -> DataFrame:
    md = F.col("md")
    return shapes(s, d).select("n_nationkey", tb.is_pure_table(md).alias("pure"), tb.parse_table(md).alias("t"), tb.row_count(md).alias("n_rows")).select("n_nationkey", "pure", "t.header", "t.separator", "n_rows")


def useless_tables(s, d) -> DataFrame:
    """Documents with a table of dashes fail as a whole."""
    key = F.col("n_nationkey")
    text = F.when(key % 5 == 0, F.lit("| - | - |\n|---|---|\n| -- | |")).otherwise(F.col("md"))
    rows = markdown(s, d).select(F.col("n_name").alias("rel_path"), F.lit(0).alias("raw"), F.lit(0).alias("ord"), F.lit("table").alias("kind"), F.lit("#/tables/0").alias("self_ref"), F.array(F.lit("H")).alias("headings"), text.alias("text"), F.lit(None).cast("string").alias("caption"))
    return ck.assemble_chunks(rows, 1 << 20).filter("error IS NOT NULL").select("rel_path", "chunk_no", "error")


def fragments(s, d) -> DataFrame:
    base = markdown(s, d)
    lines = base.select(F.col("n_name").alias("rel_path"), F.posexplode(F.split("md", "\n")).alias("pos", "piece"))
    whole = base.select(F.col("n_name").alias("rel_path"), F.lit(3).alias("pos"), F.col("md").alias("text"))
    return ck.residual_fragments(lines, whole).select("rel_path", "pos")


def conversations(s, d) -> DataFrame:
    return table(s, d, "conversations")


def chat_body():
    message = F.struct(F.struct("role", F.col("text").alias("content")).alias("message"))
    return F.when(F.col("role") == "system", F.lit('{"choices": 3}')).otherwise(F.to_json(F.struct(F.array(message).alias("choices"))))


def by_label(s, d) -> DataFrame:
    vectors = table(s, d, "embeddings").select("label", "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return vectors.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "v"))), lambda x: x["v"]).alias("vs"))


def inputs(s, d) -> DataFrame:
    parts = F.array(F.lit("  "), F.concat(F.lit(" "), "lang", F.lit(" ")), F.when(F.col("lang") == "en", F.col("source")).otherwise(F.lit("")))
    return table(s, d, "documents").select("doc_id", "text", F.when(F.col("lang") != "es", parts).alias("parts"))


def flagship_chunks(s, d, budget: int = 256) -> DataFrame:
    """The chunks of the files that a first reconcile upserts: each content once."""
    have = files(s, d).select("rel_path", "content")
    disk = rc.disk_hashes(have)
    first = rc.with_canonical(disk).filter("rel_path = canon").select("rel_path", "file_hash")
    chosen = have.join(first, "rel_path")
    split = chosen.select("rel_path", "file_hash", F.posexplode(tx.split_prose(tx.strip(F.col("content")), budget)).alias("chunk_no", "text"))
    none = F.array().cast("array<string>")
    return split.select("rel_path", "file_hash", "chunk_no", "text", none.alias("headings"), F.lit("prose").alias("chunk_type"), F.lit(None).cast("string").alias("table_ref"), none.alias("embedding_parts"), F.lit(0).alias("row_count"))


def flagship(s, d) -> DataFrame:
    """From files to points: hash, de-duplicate, chunk, embed, number."""
    made = em.points(em.embed_chunks(flagship_chunks(s, d)))
    return made.select("id", "source_path", "chunk_index", "text", "file_hash", "index_version", "chunk_type", *[F.get("vector", i).alias(f"v{i}") for i in range(3)])


def mismatched(s, d) -> DataFrame:
    """Vectors by label, the odd ones cut short; those that match their label's first."""
    v = table(s, d, "embeddings").select(F.col("label").cast("string").alias("rel_path"), F.col("vec_id").alias("chunk_index"), F.slice(F.col("embedding").cast("array<double>"), F.lit(1), F.when(F.get("embedding", 0) < 0, 63).otherwise(64)).alias("vector"))
    return em.same_dimension(v).select("rel_path", "chunk_index", F.size("vector").alias("n"))


def counted(s, d) -> DataFrame:
    """Documents whose embedder answers with another number of vectors than it got texts fail."""
    chunks = docs(s, d).select(F.col("doc_id").cast("string").alias("rel_path"), F.posexplode(tx.split_prose(F.col("text"), BUDGET)).alias("chunk_no", "text"))
    chunks = chunks.withColumn("embedding_parts", F.array("text", F.lit("again")))
    short = lambda x: F.transform(F.filter(x, lambda t: ~F.contains(t, F.lit("tion|"))), stub_vector)
    only = lambda x: F.when(F.exists(x, lambda t: F.contains(t, F.lit("!!"))), F.slice(short(x), F.lit(1), F.lit(1))).otherwise(short(x))
    return em.embed_chunks(chunks, only).groupBy("rel_path").agg(F.max("failed").alias("failed"), F.count(F.lit(1)).alias("n"))


def answers(s, d) -> DataFrame:
    """Model servers' answers in several shapes, and how many vectors are read from each."""
    v = F.array(F.col("value"), F.lit(1.0))
    bodies = F.when(F.col("event_type") == "click", F.to_json(F.struct(F.array(v).alias("embeddings")))).when(F.col("event_type") == "view", F.to_json(F.struct(v.alias("embedding")))).when(F.col("event_type") == "error", F.to_json(F.struct(F.array(v, v).alias("embeddings")))).otherwise(F.lit("{oops"))
    parsed = em.parse_embeddings(F.col("body"), F.col("expected"))
    return table(s, d, "events").select("event_id", bodies.alias("body"), F.when(F.col("user_id") > 50, 2).otherwise(1).alias("expected")).select("event_id", F.coalesce(F.size(parsed), F.lit(-1)).alias("n"), F.get(F.get(parsed, 0), 0).alias("first"))


def pictures(s, d) -> DataFrame:
    notes = F.array(F.struct(F.lit(" ").alias("text"), F.when(F.col("role") == "user", F.col("text")).alias("description")))
    return conversations(s, d).select("conv_id", "turn", tx.picture_description(notes, F.when(F.col("role") == "assistant", F.lit("meta")), F.lit("last")).alias("description"))


def payload(s, d) -> DataFrame:
    chunks = assembled(s, d).withColumn("file_hash", F.sha2("rel_path", 256))
    made = em.points(em.embed_chunks(chunks))
    return made.select("id", "source_path", "chunk_index", "chunk_type", F.array_join("headings", "/").alias("headings"), "table_ref", F.coalesce("row_count", F.lit(0)).alias("row_count"), F.char_length("text").alias("n"))


def nearest(s, d) -> DataFrame:
    points = table(s, d, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.col("label").cast("string").alias("source_path"), F.lit(0).alias("chunk_index"), F.col("embedding").cast("array<double>").alias("vector"))
    return em.nearest(points, [1.0] * 64, 10).select("id", F.round("score", 6).alias("score"))


QUERIES = {
    "flagship": flagship,
    "token_counts": lambda s, d: docs(s, d).select("doc_id", tx.token_count(F.col("text")).alias("tokens")),
    "char_windows": lambda s, d: pieces(docs(s, d), tx.char_windows(F.col("text"))),
    "hard_split": lambda s, d: pieces(docs(s, d), tx.hard_split(F.col("text"), BUDGET)),
    "split_prose": lambda s, d: pieces(docs(s, d), tx.split_prose(F.col("text"), BUDGET)),
    "split_oversized": lambda s, d: rendered(s, d).select(F.col("n_nationkey").alias("doc_id"), F.posexplode(tb.split_oversized(F.col("text"), BUDGET)).alias("pos", "piece")),
    "useful_chunks": lambda s, d: em.useful_chunks(table(s, d, "pages").select("page_id", F.explode(F.split("html", "(?=<)")).alias("text"))).groupBy("page_id").agg(F.count(F.lit(1)).alias("n")),
    "normalized_text": lambda s, d: docs(s, d).select("doc_id", F.sha2(tx.normalized(F.col("text")), 256).alias("norm")),
    "content_blocks": lambda s, d: rendered(s, d).select("n_nationkey", F.posexplode(tb.content_blocks(F.col("text"))).alias("pos", "b")).select("n_nationkey", "pos", "b.kind", "b.text"),
    "md_table_spans": lambda s, d: md_table_spans(table_lines(s, d)),
    "table_line_kinds": lambda s, d: table_lines(s, d).select("n_nationkey", "pos", tb.is_row(F.col("line")).alias("is_row"), tb.is_separator(F.col("line")).alias("is_sep")),
    "table_parse": lambda s, d: rendered(s, d).select("n_nationkey", tb.parse_table(F.col("md")).alias("t")).select("n_nationkey", "t.header", "t.separator", F.array_join("t.rows", "\n").alias("body")),
    "table_shapes": table_shapes,
    "useless_tables": useless_tables,
    "table_row_count": lambda s, d: rendered(s, d).select("n_nationkey", tb.row_count(F.col("md")).alias("n")),
    "table_chunks": lambda s, d: markdown(s, d).select("n_nationkey", tb.table_text(F.col("md"), F.col("n_name")).alias("text")),
    "table_embedding_parts": lambda s, d: markdown(s, d).select("n_nationkey", F.posexplode(tb.embedding_parts(F.col("md"), F.array(F.lit("A"), F.lit("B")), F.col("n_name"), BUDGET)).alias("pos", "part")),
    "fallback_ref": lambda s, d: docs(s, d).select("doc_id", fallback_ref(F.col("text"), F.col("doc_id") % 10).alias("ref")),
    "residual_fragments": fragments,
    "omitted_tables": lambda s, d: ck.omitted_tables(registry(s, d), ck.mixed_order(items(s, d)).filter("kind = 'table'")).select("rel_path", "ref"),
    "table_invariant": lambda s, d: ck.table_invariant(ck.assemble_chunks(items(s, d), 1 << 20), registry(s, d)),
    "mixed_order": lambda s, d: ck.mixed_order(items(s, d)).select("rel_path", "raw", "ord", "kind", "ref", "text"),
    "assemble_chunks": lambda s, d: assembled(s, d).select("rel_path", "chunk_no", "text", "chunk_type", "table_ref", "row_count", F.size("embedding_parts").alias("parts")),
    "picture_block": lambda s, d: conversations(s, d).select("conv_id", "turn", tx.picture_block(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("turn") > 1, F.col("role"))).alias("block")),
    "picture_description": pictures,
    "picture_counts": lambda s, d: pictures(s, d).groupBy("conv_id").agg(F.count_if(F.col("description") != "last").alias("described"), F.count_if(F.col("description") == "last").alias("skipped")),
    "json_content_length": lambda s, d: conversations(s, d).select("conv_id", "turn", tx.json_content_length(chat_body()).alias("n")),
    "parse_embeddings": answers,
    "embedding_inputs": lambda s, d: inputs(s, d).select("doc_id", F.posexplode(em.embedding_inputs(F.col("text"), F.col("parts"))).alias("pos", "input")),
    "embed_stub": lambda s, d: docs(s, d).select("doc_id", *[F.get(stub_vector(F.col("text")), i).alias(f"v{i}") for i in range(3)]),
    "vector_mean": lambda s, d: by_label(s, d).select("label", F.posexplode(vector_mean(F.col("vs"))).alias("pos", "x")).select("label", "pos", F.round("x", 6).alias("x")),
    "count_mismatch": counted,
    "dim_mismatch": mismatched,
    "point_payload": payload,
    "nearest_points": nearest,
}

_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_WINDOWS = """(CASE WHEN length({t}) = 0 THEN []::VARCHAR[] WHEN length({t}) <= {s} THEN [{t}] ELSE
  list_filter(list_transform(range(0, 1 + ceil((length({t}) - {s}) / {step}.0)::BIGINT), lambda k: """ + _STRIP.format("substring({t}, k * {step} + 1, {s})") + """), lambda w: w <> '') END)"""


def windows_sql(t: str, size: int, overlap: int) -> str:
    return _WINDOWS.format(t=t, s=size, step=size - overlap)


def _pieces(expression: str, source: str = "documents") -> str:
    return f"WITH w AS (SELECT doc_id, {expression} AS ps FROM (SELECT doc_id, {_STRIP.format('text')} AS t FROM {source})) SELECT doc_id, (unnest(range(len(ps))))::INT AS pos, unnest(ps) AS piece FROM w"


def prose_sql(budget: int, source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTEs that end in packed(key, ps)."""
    size = max(64, 4 * budget)
    overlap = min(150, size // 6)
    hard = windows_sql("x.buf", size, overlap)
    tok = lambda t: f"greatest(1, (length({t}) + 3) // 4)"
    flush = "CASE WHEN a.buf IS NULL THEN a.o ELSE list_append(a.o, a.buf) END"
    return f"""parts AS (SELECT {key}, {_STRIP.format(text)} AS t, CASE WHEN contains({text}, chr(10) || chr(10)) THEN chr(10) || chr(10) ELSE chr(10) END AS sep,
      list_filter(list_transform(string_split({text}, sep), lambda p: {_STRIP.format('p')}), lambda p: p <> '') AS ps FROM {source}),
    packed AS (SELECT {key}, CASE WHEN len(ps) <= 1 THEN {windows_sql('t', size, overlap)} ELSE (SELECT {flush} FROM (SELECT
      list_reduce(list_transform(ps, lambda p: {{'o': []::VARCHAR[], 'buf': p}}), lambda a, x:
        CASE WHEN {tok('x.buf')} > {budget} THEN {{'o': list_concat({flush}, {hard}), 'buf': NULL::VARCHAR}}
             WHEN a.buf IS NULL THEN {{'o': a.o, 'buf': x.buf}}
             WHEN {tok('a.buf || sep || x.buf')} > {budget} THEN {{'o': list_append(a.o, a.buf), 'buf': x.buf}}
             ELSE {{'o': a.o, 'buf': a.buf || sep || x.buf}} END, {{'o': []::VARCHAR[], 'buf': NULL::VARCHAR}}) AS a)) END AS ps FROM parts)"""


_MD = """md AS (SELECT n_nationkey, n_name, '| key | name |' || chr(10) || '|---|---|' || chr(10) || body AS md, body, n FROM nation JOIN (
  SELECT c_nationkey, string_agg('| ' || c_custkey || ' | ' || c_name || ' |', chr(10) ORDER BY c_custkey) AS body, count(*) AS n FROM customer GROUP BY 1) ON n_nationkey = c_nationkey)"""
_RESULT = f"""{_MD},
pre AS (SELECT *, n_nationkey < 5 AS more FROM md),
ass AS (
  SELECT n_name AS rel_path, 0 AS chunk_no, 'Customers of ' || n_name AS text, 'prose' AS chunk_type, NULL::VARCHAR AS table_ref, 0 AS row_count, 0 AS parts, n_nationkey FROM pre
  UNION ALL SELECT n_name, 1, 'Подпись таблицы: Customers' || chr(10) || chr(10) || md, 'table', '#/tables/0', n::INT, 1, n_nationkey FROM pre
  UNION ALL SELECT n_name, 2, 'End of table.', 'prose', NULL, 0, 0, n_nationkey FROM pre
  UNION ALL SELECT n_name, 3, 'Part' || chr(10) || '| key |', 'prose', NULL, 0, 0, n_nationkey FROM pre
  UNION ALL SELECT n_name, 4, 'Part' || chr(10) || 'More of ' || n_name, 'prose', NULL, 0, 0, n_nationkey FROM pre
  UNION ALL SELECT n_name, 5, '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |', 'table', '#/tables/1', 1, 1, n_nationkey FROM pre WHERE more)"""
_LINES = f"""{_MD}, doc AS (SELECT n_nationkey, string_split('Customers of ' || n_name || chr(10) || md || chr(10) || chr(10) || 'End.', chr(10)) AS ls FROM md),
ln AS (SELECT n_nationkey, (unnest(range(len(ls))))::INT AS pos, unnest(ls) AS line FROM doc)"""
_PICS = """pics AS (SELECT conv_id, turn, CASE WHEN role = 'user' AND trim(text) <> '' THEN trim(text) WHEN role = 'assistant' THEN 'meta' ELSE 'last' END AS description FROM conversations)"""
_STUB = ["(length({0}) % 7)::DOUBLE", "1.0::DOUBLE", "0.5::DOUBLE"]

ORACLES = {
    "flagship": f"""WITH {_FILES}, canon AS (SELECT min(rel_path) AS rel_path, file_hash FROM disk GROUP BY file_hash),
        src AS (SELECT canon.rel_path, file_hash, text FROM canon JOIN (SELECT source || '/' || doc_id || '.md' AS rel_path, {_STRIP.format('text')} AS text FROM documents) USING (rel_path)),
        {prose_sql(256, 'src', 'rel_path || chr(0) || file_hash AS k').replace('SELECT rel_path || chr(0) || file_hash AS k, CASE', 'SELECT k, CASE')},
        ch AS (SELECT split_part(k, chr(0), 1) AS source_path, split_part(k, chr(0), 2) AS file_hash, unnest(ps) AS text, unnest(range(len(ps))) AS chunk_no FROM packed),
        us AS (SELECT *, (row_number() OVER (PARTITION BY source_path ORDER BY chunk_no) - 1)::INT AS chunk_index FROM ch WHERE regexp_matches(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[\\p{{L}}\\p{{N}}]'))
        SELECT {point_id_sql('source_path', 'chunk_index')} AS id, source_path, chunk_index, text, file_hash, '{INDEX_VERSION}' AS index_version, 'prose' AS chunk_type,
          {', '.join(x.format('text') + f' AS v{i}' for i, x in enumerate(_STUB))} FROM us""",
    "token_counts": "SELECT doc_id, greatest(1, (length(text) + 3) // 4)::INT AS tokens FROM documents",
    "char_windows": _pieces(windows_sql("t", 1200, 150)),
    "hard_split": _pieces(windows_sql("t", 256, 42)),
    "split_prose": f"WITH {prose_sql(BUDGET)} SELECT doc_id, (unnest(range(len(ps))))::INT AS pos, unnest(ps) AS piece FROM packed",
    "split_oversized": f"WITH {_MD} SELECT n_nationkey AS doc_id, 0 AS pos, 'Customers of ' || n_name AS piece FROM md UNION ALL SELECT n_nationkey, 1, md FROM md UNION ALL SELECT n_nationkey, 2, 'End.' FROM md",
    "useful_chunks": """WITH p AS (SELECT page_id, unnest(string_split(regexp_replace(html, '<', chr(1) || '<', 'g'), chr(1))) AS t FROM pages)
        SELECT page_id, count(*) AS n FROM p WHERE regexp_matches(regexp_replace(t, '<[^>]+>', ' ', 'g'), '[\\p{L}\\p{N}]') GROUP BY page_id""",
    "normalized_text": "SELECT doc_id, sha256(array_to_string(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\\p{L}\\p{N}]+'), ' ')) AS norm FROM documents",
    "content_blocks": f"WITH {_MD} SELECT n_nationkey, 0 AS pos, 'prose' AS kind, 'Customers of ' || n_name AS text FROM md UNION ALL SELECT n_nationkey, 1, 'table', md FROM md UNION ALL SELECT n_nationkey, 2, 'prose', 'End.' FROM md",
    "md_table_spans": f"""WITH {_LINES}, k AS (SELECT *, line LIKE '|%|' AS r, regexp_matches(line, '^\\s*\\|?\\s*:?-{{2,}}:?\\s*(\\|\\s*:?-{{2,}}:?\\s*)+\\|?\\s*$') AS s FROM ln),
        i AS (SELECT *, sum(CASE WHEN r OR s THEN 0 ELSE 1 END) OVER (PARTITION BY n_nationkey ORDER BY pos) AS island, r AND NOT s AND coalesce(lead(s) OVER (PARTITION BY n_nationkey ORDER BY pos), false) AS opens FROM k)
        SELECT n_nationkey, min(pos) FILTER (opens) AS "first", max(pos) AS "last" FROM i WHERE r OR s GROUP BY n_nationkey, island HAVING "first" IS NOT NULL""",
    "table_line_kinds": f"WITH {_LINES} SELECT n_nationkey, pos, line LIKE '|%|' AS is_row, line = '|---|---|' AS is_sep FROM ln",
    "table_parse": f"WITH {_MD} SELECT n_nationkey, '| key | name |' AS header, '|---|---|' AS separator, body FROM md",
    "table_shapes": """WITH c AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS nth FROM customer),
        r AS (SELECT c_nationkey AS k, list([c_custkey::VARCHAR, c_name, c_mktsegment, c_nationkey::VARCHAR, 'x', upper(c_name)][1:c_nationkey % 6 + 1] ORDER BY c_custkey) AS rs FROM c WHERE nth <= 5 GROUP BY c_nationkey),
        t AS (SELECT k, k % 5 AS s, k % 6 + 1 AS c, rs, '| ' || array_to_string(['h0', 'h1', 'h2', 'h3', 'h4', 'h5'][1:k % 6 + 1], ' | ') || ' |' AS head, list_transform(rs, lambda x: '| ' || array_to_string(x, ' | ') || ' |') AS body FROM r),
        l AS (SELECT *, CASE s WHEN 0 THEN list_concat([head, '|' || repeat(':--:|', c)], body) WHEN 1 THEN list_concat([head], body) WHEN 2 THEN list_concat([head, '|' || repeat('-|', c)], body)
            WHEN 3 THEN list_concat(list_concat(['<table>'], list_transform(rs, lambda x: '<tr><td>' || array_to_string(x, '</td><td>') || '</td></tr>')), ['</table>']) ELSE list_concat([head, 'note', '|' || repeat('---|', c)], body) END AS ls FROM t),
        f AS (SELECT *, list_transform(ls, lambda x: regexp_matches(x, '^\\|.*\\|$')) AS r, list_transform(ls, lambda x: regexp_matches(x, '^\\s*\\|?\\s*:?-{2,}:?\\s*(\\|\\s*:?-{2,}:?\\s*)+\\|?\\s*$')) AS p FROM l),
        a AS (SELECT *, coalesce(list_position(list_transform(range(1, len(ls)), lambda i: r[i] AND NOT p[i] AND p[i + 1]), true), 0) AS fi, len(list_filter(range(2, len(ls) + 1), lambda i: r[i])) AS below,
            len(list_filter(range(1, len(ls) + 1), lambda i: NOT (r[i] OR p[i]))) = 0 AS whole FROM f)
        SELECT k AS n_nationkey, s = 3 OR (s = 0 AND c > 1) AS pure, CASE WHEN fi > 0 THEN ls[fi] WHEN whole AND below > 0 THEN ls[1] WHEN s = 3 THEN array_to_string(ls, chr(10)) END AS header,
          CASE WHEN fi > 0 THEN ls[fi + 1] END AS separator, (CASE WHEN fi > 0 THEN len(list_filter(range(fi + 2, len(ls) + 1), lambda i: r[i])) WHEN whole THEN below ELSE 0 END)::INT AS n_rows FROM a""",
    "useless_tables": f"WITH {_MD} SELECT n_name AS rel_path, 0 AS chunk_no, 'a table without useful text' AS error FROM md WHERE n_nationkey % 5 = 0",
    "table_row_count": f"WITH {_MD} SELECT n_nationkey, n::INT AS n FROM md",
    "table_chunks": f"WITH {_MD} SELECT n_nationkey, CASE WHEN contains(md, n_name) THEN md ELSE 'Подпись таблицы: ' || n_name || chr(10) || chr(10) || md END AS text FROM md",
    "table_embedding_parts": f"""WITH {_MD}, f AS (SELECT *, '[Таблица]' || chr(10) || 'Раздел: A / B' || chr(10) || 'Подпись: ' || n_name || chr(10) || chr(10) AS p FROM md),
        g AS (SELECT *, p || '| key | name |' || chr(10) || '|---|---|' AS fixed FROM f),
        r AS (SELECT *, list_reduce(list_transform(string_split(body, chr(10)), lambda b: {{'o': []::VARCHAR[], 'buf': fixed || chr(10) || b}}), lambda a, x:
          CASE WHEN a.buf IS NULL THEN {{'o': a.o, 'buf': x.buf}}
               WHEN (length(a.buf) + length(x.buf) - length(fixed) + 3) // 4 > {BUDGET} THEN {{'o': list_append(a.o, a.buf), 'buf': x.buf}}
               ELSE {{'o': a.o, 'buf': a.buf || substr(x.buf, length(fixed) + 1)}} END, {{'o': []::VARCHAR[], 'buf': NULL::VARCHAR}}) AS a FROM g),
        e AS (SELECT n_nationkey, CASE WHEN (length(p || md) + 3) // 4 <= {BUDGET} THEN [p || md] ELSE list_append(a.o, a.buf) END AS ps FROM r)
        SELECT n_nationkey, (unnest(range(len(ps))))::INT AS pos, unnest(ps) AS part FROM e""",
    "fallback_ref": f"SELECT doc_id, 'markdown:' || (doc_id % 10) || ':' || substr(sha256({_STRIP.format('text')}), 1, 16) AS ref FROM documents",
    "residual_fragments": f"""WITH {_MD}, l AS (SELECT n_name AS rel_path, md, unnest(string_split(md, chr(10))) AS piece, unnest(range(len(string_split(md, chr(10)))))::INT AS pos FROM md),
        z AS (SELECT *, array_to_string(regexp_extract_all(lower(piece), '[\\p{{L}}\\p{{N}}]+'), ' ') AS x, array_to_string(regexp_extract_all(lower(md), '[\\p{{L}}\\p{{N}}]+'), ' ') AS y FROM l)
        SELECT rel_path, pos FROM z WHERE pos > 3 AND (x = '' OR (x <> y AND contains(y, x)))""",
    "omitted_tables": "SELECT n_name AS rel_path, '#/tables/1' AS ref FROM nation WHERE n_nationkey < 5 AND n_nationkey IN (SELECT c_nationkey FROM customer)",
    "table_invariant": "SELECT n_name AS rel_path, '#/tables/1' AS ref, 0::BIGINT AS n FROM nation WHERE n_nationkey < 5 AND n_nationkey IN (SELECT c_nationkey FROM customer)",
    "mixed_order": f"""WITH {_MD} SELECT n_name AS rel_path, 0 AS raw, 0 AS ord, 'prose' AS kind, NULL AS ref, 'Customers of ' || n_name AS text FROM md
        UNION ALL SELECT n_name, 0, 1, 'table', '#/tables/0', md FROM md UNION ALL SELECT n_name, 0, 2, 'prose', NULL, 'End of table.' FROM md
        UNION ALL SELECT n_name, 2, 0, 'prose', NULL, 'Part' || chr(10) || '| key |' FROM md UNION ALL SELECT n_name, 3, 0, 'prose', NULL, 'Part' || chr(10) || 'More of ' || n_name FROM md""",
    "assemble_chunks": f"WITH {_RESULT} SELECT rel_path, chunk_no, text, chunk_type, table_ref, row_count, parts FROM ass",
    "picture_block": "SELECT conv_id, turn, CASE WHEN role = 'user' AND trim(text) <> '' THEN '[Изображение]' || chr(10) || 'Описание: ' || trim(text) || CASE WHEN turn > 1 THEN chr(10) || 'Подпись: ' || role ELSE '' END ELSE '' END AS block FROM conversations",
    "picture_description": f"WITH {_PICS} SELECT * FROM pics",
    "picture_counts": f"WITH {_PICS} SELECT conv_id, count(*) FILTER (description <> 'last') AS described, count(*) FILTER (description = 'last') AS skipped FROM pics GROUP BY conv_id",
    "json_content_length": "SELECT conv_id, turn, CASE WHEN role = 'system' THEN 0 ELSE length(text)::INT END AS n FROM conversations",
    "parse_embeddings": """SELECT event_id, CASE WHEN event_type IN ('click', 'view') AND user_id <= 50 THEN 1 WHEN event_type = 'error' THEN CASE WHEN user_id > 50 THEN 2 ELSE 1 END ELSE -1 END::INT AS n,
        CASE WHEN event_type IN ('click', 'view') AND user_id <= 50 OR event_type = 'error' THEN value END AS "first" FROM events""",
    "embedding_inputs": f"""SELECT doc_id, 0 AS pos, CASE WHEN lang = 'es' THEN {_STRIP.format('text')} ELSE lang END AS input FROM documents UNION ALL SELECT doc_id, 1, source FROM documents WHERE lang = 'en'""",
    "embed_stub": f"SELECT doc_id, {', '.join(x.format('text') + f' AS v{i}' for i, x in enumerate(_STUB))} FROM documents",
    "vector_mean": """WITH v AS (SELECT label, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS x FROM embeddings),
        m AS (SELECT label, pos, avg(x) AS x FROM v GROUP BY label, pos) SELECT label, pos::INT AS pos, round(x / sqrt(sum(x * x) OVER (PARTITION BY label)), 6) AS x FROM m""",
    "count_mismatch": f"""WITH {prose_sql(BUDGET)}, c AS (SELECT doc_id, unnest(ps) AS t FROM packed), u AS (SELECT * FROM c WHERE regexp_matches(regexp_replace(t, '<[^>]+>', ' ', 'g'), '[\\p{{L}}\\p{{N}}]'))
        SELECT doc_id::VARCHAR AS rel_path, bool_or(contains(t, '!!') OR contains(t, 'tion|')) AS failed, count(*) AS n FROM u GROUP BY doc_id""",
    "dim_mismatch": """WITH v AS (SELECT label::VARCHAR AS rel_path, vec_id AS chunk_index, CASE WHEN embedding[1] < 0 THEN 63 ELSE 64 END AS n FROM embeddings)
        SELECT rel_path, chunk_index, n FROM (SELECT *, first_value(n) OVER (PARTITION BY rel_path ORDER BY chunk_index) AS f FROM v) WHERE n = f""",
    "point_payload": f"""WITH {_RESULT} SELECT {point_id_sql('rel_path', 'chunk_no')} AS id, rel_path AS source_path, chunk_no AS chunk_index, chunk_type, CASE WHEN chunk_no < 5 THEN 'Part' END AS headings,
        table_ref, row_count, length(text)::INT AS n FROM ass""",
    "nearest_points": """SELECT vec_id::VARCHAR AS id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) / 8, 6) AS score
        FROM embeddings ORDER BY list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) DESC, id LIMIT 10""",
}
