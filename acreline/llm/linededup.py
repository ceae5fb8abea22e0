"""Line dedup with DataFrame functions only.

Every line becomes two hashes of its key; the key is the line without white
space (``[\\x20\\x09-\\x0D]``) at its ends and with A-Z lower-cased. The hashed
lines are range-partitioned by (hash, document) and sorted by position, so one
streaming pass tells a key's first line in a document; a key in a third of
all documents spreads over as many ranges as its documents need. The counts
of documents per key are summed before they are exchanged. Back to a document
goes a compressed bitmap of its lines: the runs of dropped positions.

Two bitmaps of a fixed size are broadcast. One of the frequent keys leaves
out lines whose key is not one before lines and keys meet (on salted keys);
one of the documents that lose lines leaves all other texts where they are,
so only texts that change are exchanged.

A document is known by its id, a row without an id by a hash of its text.
Rows equal in id and text lose the same lines. A null text is one empty line;
lines with an empty key are never dropped. Columns other than ``doc_id`` and
``text`` pass through untouched, but for those that have a result's name.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreline.llm.bitmap import bitmap, marked
from acreline.runtime import stored

MIN_DOCS = 10
#: Parts that the lines of one frequent key are dealt to when they meet it.
SALT = 32

_ENDS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("_n_lines", "_n_dropped", "_kept")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case (``lower`` alone would fold beyond ASCII)."""
    key = F.trim(line, F.lit(_ENDS))
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def drop_runs(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """``_d, _t, _runs array<struct<start, n>>`` of the documents (id, hash of text) that lose lines.

    Keys in at least ``min_docs`` documents lose all their lines or, with
    ``keep_first``, all but the first by document and position.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("_d"), _text().alias("_x")).withColumn("_t", F.xxhash64("_x"))
    lines = text.select("_d", "_t", F.posexplode(_lines(F.col("_x"))).alias("_p", "_line")).select("_d", "_t", "_p", line_key(F.col("_line")).alias("_k")).where("_k <> ''")
    lines = stored(lines.select(F.xxhash64("_k").alias("_h"), F.hash("_k").alias("_g"), "_d", "_t", "_p"), "lines")
    known = lines.withColumn("_e", F.when(F.col("_d").isNull(), F.col("_t")).otherwise(0))
    document = ("_h", "_g", "_d", "_e")
    first = F.row_number().over(Window.partitionBy(*document).orderBy("_t", "_p")) == 1
    often = known.repartitionByRange(*document).withColumn("_first", first).where("_first").groupBy("_h", "_g")
    often = stored(often.agg(F.count("*").alias("_n"), F.min(F.struct("_d", "_t", "_p")).alias("_at")).where(F.col("_n") >= min_docs).select("_h", "_g", "_at"), "often")
    frequent = marked(lines, bitmap(often, F.col("_h")), F.col("_h")).where("_may").drop("_may")
    salted = frequent.withColumn("_s", F.pmod(F.xxhash64("_d", "_t", "_p"), F.lit(SALT)).cast("int"))
    lost = salted.join(often.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), ["_h", "_g", "_s"])
    if keep_first:
        lost = lost.where(~F.struct("_d", "_t", "_p").eqNullSafe(F.col("_at")))
    lost = lost.select("_d", "_t", "_p").distinct()
    island = F.col("_p") - F.row_number().over(Window.partitionBy("_d", "_t").orderBy("_p"))
    runs = lost.withColumn("_i", island).groupBy("_d", "_t", "_i").agg(F.min("_p").alias("start"), F.count("*").cast("int").alias("n"))
    return runs.groupBy("_d", "_t").agg(F.array_sort(F.collect_list(F.struct("start", "n"))).alias("_runs"))


def _applied(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``row`` (a struct of the columns of docs), ``n_lines, n_dropped, kept``."""
    runs = stored(runs.withColumnsRenamed({"_d": "_rd", "_t": "_rt"}), "runs")
    known = docs.select(F.struct(*docs.columns).alias("row"), _text().alias("_x"), F.col("doc_id").cast("long").alias("_d")).withColumn("_t", F.xxhash64("_x"))
    known = marked(known, bitmap(runs, F.xxhash64("_rd", "_rt")), F.xxhash64("_d", "_t"))
    whole = known.where("not _may").select("row", F.size(_lines(F.col("_x"))).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.col("_x").alias("kept"))
    met = known.where("_may").join(runs, F.col("_d").eqNullSafe(F.col("_rd")) & (F.col("_t") == F.col("_rt")), "left")
    met = met.select("row", _lines(F.col("_x")).alias("_all"), F.coalesce("_runs", F.array().cast(runs.schema["_runs"].dataType)).alias("_runs"))
    lo = F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["start"] + r["n"]))
    hi = F.concat(F.transform("_runs", lambda r: r["start"]), F.array(F.size("_all")))
    spans = F.filter(F.zip_with(lo, hi, lambda a, b: F.struct(a.alias("a"), (b - a).alias("n"))), lambda s: s["n"] > 0)
    left = F.flatten(F.transform(spans, lambda s: F.slice(F.col("_all"), s["a"] + 1, s["n"])))
    gone = F.aggregate("_runs", F.lit(0).cast("long"), lambda acc, r: acc + r["n"])
    return whole.union(met.select("row", F.size("_all").cast("long").alias("n_lines"), gone.alias("n_dropped"), F.array_join(left, "\n").alias("kept")))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """docs with ``_n_lines, _n_dropped, _kept`` (the text of the lines that stay) in place of columns so named."""
    made = _applied(docs, drop_runs(docs, min_docs, keep_first))
    return made.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in RESULT), *(F.col(c[1:]).alias(c) for c in RESULT))


ORACLE = """
with l as (
  select rid, doc_id, text, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select row_number() over () as rid, doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents)),
f as (select k from l where k <> '' group by k having count(distinct coalesce(doc_id::varchar, 'without ' || coalesce(text, ''))) >= 10),
m as (select l.*, f.k is not null as lost from l left join f on l.k = f.k)
select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not lost), '')) as kept_sha256
from m group by rid, doc_id
"""


def keep_first_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the lines of ``min_docs`` documents left in the first of them only, all columns as they were.

    Documents that lose every line go; ``n_chars``, if there, follows the
    text. A text that loses nothing stays as it is, null too.
    """
    made = _applied(docs, drop_runs(docs, min_docs, keep_first=True)).where("n_dropped < n_lines")
    own = lambda c: F.col("row")[c]
    changed = {"text": F.col("kept").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return made.select(*(F.when(F.col("n_dropped") > 0, changed[c]).otherwise(own(c)).alias(c) if c in changed else own(c).alias(c) for c in docs.columns))
