"""Line deduplication by a log-template tree, in native Spark functions.

The tree has a fixed depth: a line goes by its number of tokens, then by its `DEPTH` leading tokens, to a leaf. Tokens
with a digit are variable fields from the start. In a leaf with `SUPPORT` different lines or more, a token stays in the
template if that many of them have it at the same place; others are variable fields too. Such a template needs
`CONSTANT` of its tokens constant, one of them at least beyond the leading ones, which all lines of a leaf share; any
other line is its own template. A template of fields alone is none.

A template recurs if it stands in `SUPPORT` different texts or more; its lines are dropped, whatever their length and
neighbours. Equal texts count as one, so copies of a document keep their lines, however many they are, and are left to
document deduplication.

Lines travel as hashes. What recurs is decided for each different line, after a partial count in each task; a line that
stands in very many documents is a large key of one join alone, which Spark splits. The texts of lines are shuffled
once, those of large leaves alone while these are few enough to be sent to all tasks, and the documents once.

Texts are told apart by 64-bit hashes. Two that share one count as one text, so a line may count one text too few; they
lose no line by it that recurs nowhere, since what recurs is told by the line.

Edge cases: a null text stays null and has no lines; blank lines are kept; rows of equal text lose the same lines,
whatever their ids; near copies are different texts; null ids are kept; other columns pass through, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bind, discard, stored

DEPTH, SUPPORT, CONSTANT = 3, 5, 0.6
FIELD = "<*>"
#: The most leaves or lines, a number each, that are sent to all tasks: some 25 MB there.
BROADCAST_KEYS = 1_000_000


def masked(line: Column) -> Column:
    """The line with each token that holds a digit made a field and single blanks between tokens.

    Most lines need neither, so both regular expressions run only where a cheap test says so.
    """

    def fields(clean: Column) -> Column:
        return F.when(clean.rlike("[0-9]"), F.regexp_replace(clean, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)).otherwise(clean)

    def single(bare: Column) -> Column:
        wide = bare.contains("  ")
        for c in SPACES[1:]:
            if c != "\n":
                wide |= bare.contains(c)
        return F.when(wide, F.regexp_replace(bare, r"[\x20\x09-\x0D]+", " ")).otherwise(bare)

    return bind(F.btrim(line, F.lit(SPACES)), lambda x: bind(single(x), fields))


def _lines(rows: DataFrame) -> DataFrame:
    """(row, mask, line, n, leaf) for each line of rows (row, text) that has a token other than a field."""
    split = rows.select("row", F.explode(F.transform(F.split("text", "\n", -1), masked)).alias("mask"))
    n = F.length("mask") - F.length(F.replace("mask", F.lit(" "), F.lit(""))) + 1
    solid = (F.col("mask") != "") & (~F.col("mask").contains(FIELD) | F.col("mask").rlike(r"(?<![^ ])(?!<\*>(?![^ ]))[^ ]"))
    return split.filter(solid).withColumn("n", n).select("row", "mask", F.xxhash64("mask").alias("line"), "n", F.xxhash64("n", F.substring_index("mask", " ", DEPTH)).alias("leaf"))


def _few(keys: DataFrame) -> DataFrame:
    """keys with a broadcast hint after a count of them; more are shuffled."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def recurring_lines(rows: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(row, lines): for each document the hashes of its lines that go, from rows (row, text), where equal texts
    have one row."""
    lines = _lines(rows)
    seen = stored(lines.select("leaf", "line", "row").distinct())
    counted = stored(seen.groupBy("leaf", "line").agg(F.count("*").alias("rows")))
    leaves = stored(counted.groupBy("leaf").agg(F.count("*").alias("size")).filter(F.col("size") >= support).select("leaf"))
    # what is constant in large leaves; a line of at most DEPTH tokens is alone in its leaf
    tokens = stored(lines.join(_few(leaves), "leaf", "left_semi").groupBy("leaf", "line", "n").agg(F.min("mask").alias("mask")).select("leaf", "line", "n", F.posexplode(F.split("mask", " ")).alias("i", "token")).withColumn("token", F.when(F.col("token") != FIELD, F.xxhash64("token"))))
    constant = tokens.filter("token is not null").groupBy("leaf", "i", "token").agg(F.count("*").alias("m")).filter(F.col("m") >= support).select("leaf", "i", "token")
    shapes = tokens.join(constant, ["leaf", "i", "token"]).groupBy("leaf", "line", "n").agg(F.count("*").alias("fixed"), F.sum(F.xxhash64("i", "token").cast("decimal(38,0)")).alias("sum"), F.max("i").alias("last"))
    enough = (F.col("fixed") >= CONSTANT * F.col("n")) & (F.col("last") >= DEPTH)
    general = stored(shapes.filter(enough).select("leaf", "line", F.xxhash64("leaf", "sum", "fixed").alias("template")))
    # templates of several lines: their different documents
    spread = seen.join(_few(general), ["leaf", "line"]).select("template", "row").distinct().groupBy("template").agg(F.count("*").alias("rows"))
    often = spread.filter(F.col("rows") >= support).select("template")
    alone = counted.filter(F.col("rows") >= support).select("leaf", "line")
    gone = stored(alone.union(general.join(often, "template").select("leaf", "line")).distinct())
    found = stored(seen.join(_few(gone), ["leaf", "line"], "left_semi").groupBy("row").agg(F.collect_set("line").alias("lines")))
    discard(seen, counted, leaves, tokens, general, gone)
    return found


def drop_recurring_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", support: int = SUPPORT, n_lines: str = "__n_lines", n_dropped: str = "__n_dropped") -> DataFrame:
    """docs with recurring lines cut from the text, and two counts under the given names."""
    text = F.col(f"doc.`{text_col}`")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64(f"`{text_col}`").alias("row"))
    # both sides grow with the documents, so the join is planned as one of two shuffled sides at every size
    gone = recurring_lines(whole.select("row", text.alias("text")), support=support).hint("merge")
    all_ = F.split(text, "\n", -1)
    kept = F.filter(all_, lambda x: ~F.array_contains(F.col("lines"), F.xxhash64(masked(x))))
    cut = whole.join(gone, "row", "left").withColumn("kept", F.when(F.col("lines").isNotNull(), kept))
    left = F.coalesce(F.array_join("kept", "\n"), text)
    counts = [F.when(text.isNull(), 0).otherwise(F.size(all_)), F.when(F.col("kept").isNull(), 0).otherwise(F.size(all_) - F.size("kept"))]
    fields = [left.alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns]
    return cut.select(*fields, *[x.cast("long").alias(c) for x, c in zip(counts, (n_lines, n_dropped), strict=True)])
