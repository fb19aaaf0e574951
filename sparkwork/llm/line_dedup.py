"""Line dedup: a suffix array over line-id sequences by distributed prefix doubling; DataFrame functions only.

Lines with words are numbered through the corpus in document order (their places).  Round k ranks the runs of 2^k
lines by the pair of ranks of their halves: the different pairs that occur more than once are put in order by a
range shuffle, and their numbers in this order are the next ranks.  A place's ranks, level by level, are so the key that
sorts the suffixes, and the places of one rank are an interval of the suffix array whose common prefix is 2^k lines
at least.  Runs that occur once drop out; the rounds end when no run repeats, whatever its length.

An interval's first place stays, its later places are copies.  From each place the longest run found so is deleted;
runs of other lengths than powers of two are covered by two that overlap.  With a floor on a run's words (``min_words``),
every line of a run lies in a window of as few lines as hold that many words, counted forward or backward from some
line of the run; a window is named by its length and two overlapping ranks, windows of one name are an interval too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import read_table
from .common import free_name, stored

MIN_WORDS = 1  # one line
KEY = ["doc_id", "tie"]


def text_lines() -> Column:
    return F.split("text", "\n")


def word_count(line: Column) -> Column:
    """Words between single spaces of a trimmed line; 0 for an empty one."""
    return F.when(line == "", F.lit(0)).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def numbered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, line, h, g, w, place) of every line with words; places ascend with doc_id (nulls first), tie and line.

    ``tie`` is the text's hash: rows equal in both are one document.  A line's id is two hashes of it, 96 bits.
    """

    def entry(line: Column, i: Column) -> Column:
        bare = F.trim(line)
        return F.struct(
            i.alias("line"), F.xxhash64(bare).alias("h"), F.hash(F.lit(7), bare).alias("g"), word_count(bare).alias("w")
        )

    entries = F.filter(F.transform(text_lines(), entry), lambda e: e["w"] > 0)
    rows = docs.filter("text is not null").select("doc_id", F.xxhash64("text").alias("tie"), entries.alias("entries"))
    rows = rows.dropDuplicates(KEY).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = rows.select(*KEY, F.explode("entries").alias("e")).select(*KEY, "e.*")
    return stored(rows.withColumn("place", F.monotonically_increasing_id()), "lines")  # in partition order


def ranked(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """(by, rank, first) of the keys that occur more than once: ranks ascend with the keys, ``first`` is the first place.

    Written, so that a join can split a hot key.
    """
    found = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("place").alias("first")).filter("n > 1").drop("n")
    found = stored(found, label)
    ordered = found.repartitionByRange(*by).sortWithinPartitions(*by)
    return stored(ordered.select(*by, F.monotonically_increasing_id().alias("rank"), "first"), label)


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The lines that occur more than once: (doc_id, tie, line, w, place, chain, rank, first); a chain has consecutive places."""
    active = lines.join(ranked(lines, ["h", "g"], "line-ranks"), ["h", "g"]).drop("h", "g")
    chain = F.col("place") - F.row_number().over(Window.partitionBy(*KEY).orderBy("place"))
    return stored(active.withColumn("chain", chain), "repeated-lines")


def doubled_ranks(active: DataFrame) -> DataFrame:
    """(level, place, rank, first) of every run of 2^level lines that occurs more than once."""
    ranks = active.select("chain", "place", "rank", "first")
    out = ranks.select(F.lit(0).alias("level"), "place", "rank", "first")
    level = 0
    while True:
        second = ranks.select("chain", (F.col("place") - (1 << level)).alias("place"), F.col("rank").alias("rank2"))
        pairs = ranks.select("chain", "place", F.col("rank").alias("rank1")).join(second, ["chain", "place"])
        names = ranked(pairs, ["rank1", "rank2"], "run-ranks")
        if names.isEmpty():
            return out
        ranks = stored(pairs.join(names, ["rank1", "rank2"]).select("chain", "place", "rank", "first"), "runs")
        level += 1
        out = out.unionByName(ranks.select(F.lit(level).alias("level"), "place", "rank", "first"))


def suffix_array(docs: DataFrame) -> DataFrame:
    """(place, doc_id, tie, line, ranks, lines) of the repeated lines in the order of the suffixes that begin there.

    ``ranks`` (level by level) is the sort key; ``lines`` is the largest power of two of lines from here on that also
    stand elsewhere.  Lines are in the order of their ids, not of their characters.
    """
    active = repeated_lines(numbered_lines(docs))
    levels = doubled_ranks(active).groupBy("place").agg(F.array_sort(F.collect_list(F.struct("level", "rank"))).alias("found"))
    keys = levels.select("place", F.transform("found", lambda f: f["rank"]).alias("ranks"), F.expr("shiftleft(1L, size(found) - 1)").alias("lines"))
    return active.select("place", *KEY, "line").join(keys, "place").orderBy("ranks", "place")


def later_runs(active: DataFrame, ranks: DataFrame) -> DataFrame:
    """(doc_id, tie, line): the lines that the longest earlier runs from their document's places reach."""
    longest = ranks.filter("first < place").groupBy("place").agg(F.max("level").alias("level"))
    upto = Window.partitionBy(*KEY).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.expr("place + shiftleft(1L, level) - 1")).over(upto)  # runs end within their document
    return active.join(longest, "place", "left").withColumn("reach", reach).filter("reach >= place").select(*KEY, "line")


def windows(active: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, tie, s, m): first place and lines of the minimal windows of ``min_words`` words, forward and backward of each line."""
    chain = Window.partitionBy(*KEY, "chain")
    active = active.withColumn("upto", F.sum("w").over(chain.orderBy("place")))
    active = active.withColumn("before", F.col("upto") - F.col("w"))
    ahead = chain.orderBy("before").rangeBetween(0, min_words - 1)
    back = chain.orderBy("upto").rangeBetween(-(min_words - 1), 0)

    def window(start: Column, over) -> Column:
        return F.when(F.sum("w").over(over) >= min_words, F.struct(start.alias("s"), F.count("*").over(over).alias("m")))

    both = active.select(
        *KEY, window(F.col("place"), ahead).alias("ahead"), window(F.min("place").over(back), back).alias("back")
    )
    return both.select(*KEY, F.explode(F.array("ahead", "back")).alias("w")).select(*KEY, "w.*").filter("s is not null")


def later_windows(active: DataFrame, ranks: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, tie, line): the lines of the minimal windows that also stand earlier."""
    ranks = ranks.select("level", F.col("place").alias("at"), "rank")
    seeds = stored(windows(active, min_words), "line-windows").withColumn("level", F.length(F.bin("m")) - 1)
    seeds = seeds.withColumn("at", F.col("s")).join(ranks, ["level", "at"]).withColumnRenamed("rank", "head")
    seeds = seeds.withColumn("at", F.expr("s + m - shiftleft(1L, level)")).join(ranks, ["level", "at"])
    seeds = stored(seeds.withColumnRenamed("rank", "tail").drop("level", "at"), "run-windows")
    name = ["head", "tail", "m"]
    first = seeds.groupBy(*name).agg(F.count("*").alias("n"), F.min("s").alias("first")).filter("n > 1")
    later = seeds.join(stored(first, "window-names"), name).filter("s > first")
    places = later.select(F.explode(F.sequence("s", F.expr("s + m - 1"))).alias("place")).distinct()
    return active.join(places, "place").select(*KEY, "line")


def removable_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tie, removed): the line numbers, from 0, of each document's later copies; documents without any are absent."""
    active = repeated_lines(numbered_lines(docs))
    ranks = doubled_ranks(active)
    later = later_runs(active, ranks) if min_words <= 1 else later_windows(active, ranks, min_words)
    return later.groupBy(*KEY).agg(F.collect_set("line").alias("removed"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of ``text``, and columns n_lines and n_removed added.

    A run is a sequence of consecutive lines (empty lines don't count, and stay) of at least ``min_words`` words
    that also stands earlier, in the order of doc_id (null first), text hash and line; runs may overlap.  Lines are equal if they are so without the spaces around them.  All other columns and rows are kept, a
    document that loses every line has an empty text.  A null text stays null, with 0 lines; an empty text is
    one line without words; rows equal in doc_id and text are one document and get one result; an empty table gives no
    rows.  Where ``docs`` has a column n_lines or n_removed, the added one has an underscore before its name.
    """
    tie, gone_id, gone_tie, removed, n_lines, n_removed = (
        free_name(c, docs) for c in ("tie", "gone_id", "gone_tie", "removed", "n_lines", "n_removed")
    )
    gone = stored(removable_lines(docs.select("doc_id", "text"), min_words), "removed-lines")
    gone = gone.withColumnsRenamed({"doc_id": gone_id, "tie": gone_tie, "removed": removed})
    met = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(tie) == F.col(gone_tie))
    # one plan whatever the number of removed lines
    out = docs.withColumn(tie, F.xxhash64("text")).join(gone.hint("merge"), met, "left")
    lines = text_lines()
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return out.select(
        *[F.when(F.col(removed).isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias(n_lines),
        F.coalesce(F.size(removed), F.lit(0)).cast("long").alias(n_removed),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op9_line_dedup": op9_line_dedup}



def oracle(min_words: int) -> str:
    return f"""
with parts as (
    select doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line
    from documents where text is not null
), l as (
    select doc_id, line, trim(raw) as t, length(trim(raw)) - length(replace(trim(raw), ' ', '')) + 1 as w
    from parts where trim(raw) <> ''
), c as (
    select *, row_number() over (order by doc_id, line) as place,
        sum(w) over (partition by doc_id order by line) as upto from l
), f as (
    select doc_id, place as s, max(place) over a as e, string_agg(t, chr(10)) over a as run, sum(w) over a as words
    from c window a as (partition by doc_id order by upto - w range between current row and {min_words - 1} following)
), b as (
    select doc_id, min(place) over a as s, place as e, string_agg(t, chr(10)) over a as run, sum(w) over a as words
    from c window a as (partition by doc_id order by upto range between {min_words - 1} preceding and current row)
), later as (
    select * from (
        select *, min(s) over (partition by run) as first_s
        from (select * from f union all select * from b) where words >= {min_words}
    ) where s > first_s
), gone as (
    select distinct c.doc_id, c.line from c join later r on c.doc_id = r.doc_id and c.place between r.s and r.e
), lines as (
    select p.doc_id, count(*) as n_lines, count(g.line) as n_removed,
        coalesce(string_agg(p.raw, chr(10) order by p.line) filter (g.line is null), '') as text
    from parts p left join gone g on p.doc_id = g.doc_id and p.line = g.line group by p.doc_id
)
select d.doc_id, l.text, coalesce(l.n_lines, 0) as n_lines, coalesce(l.n_removed, 0) as n_removed
from documents d left join lines l on d.doc_id = l.doc_id
"""


ORACLE = {"op9_line_dedup": oracle(MIN_WORDS)}
