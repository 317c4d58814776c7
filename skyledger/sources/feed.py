"""Reading the raw feed: a CSV with a header, every value kept as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import constants as K


CORRUPT = "_corrupt_line"
# Files whose names are sent to every task: some 20 MB.
FEW_FILES = 100_000
# A position is the file's rank, then 43 bits for the place in it.
IN_FILE, IN_PART = 1 << 43, (1 << 33) - 1


def read_feed(spark: SparkSession, path: str, multi_line: bool = False, strict: bool = True) -> DataFrame:
    """Columns are taken by header name; ``src_row``, a long, orders rows as they stand in the files.

    All files must have the header of the first; the read stops with a message at one that has not. Rows with too few
    or too many fields are malformed whichever columns are read: a strict read stops at them, the other fills up short
    rows with nulls, cuts long ones, and names both in ``problem``. Values with line breaks in quotes need
    ``multi_line``, which keeps a file in one task. Literal ``NA`` stays text.

    A position is (rank of the file by name, start of the block, row within the read). Every row has at least a byte
    for each separator, so rows of a block never reach the positions of the next block, and the order is the same
    however the files are split over tasks.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])
    # Without pruning every row is parsed whole, so a malformed one shows whatever is read.
    raw = spark.read.options(
        **options, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False
    )
    raw = raw.schema(schema).csv(path)
    # Local files are spelt with one slash here and with three there.
    files = sorted(f.replace(":///", ":/", 1) for f in raw.inputFiles())
    path_of = F.replace(F.col("_metadata.file_path"), F.lit(":///"), F.lit(":/"))
    raw = raw.withColumn("_file", path_of).withColumn("_block", F.col("_metadata.file_block_start"))
    raw = raw.withColumn("_nth", F.monotonically_increasing_id().bitwiseAND(IN_PART))
    if len(files) > 1:
        ranks = spark.createDataFrame(list(enumerate(files)), "_rank long, _file string")
        ranks = F.broadcast(ranks) if len(files) <= FEW_FILES else ranks
        raw = raw.join(ranks, "_file", "left")
        missing = F.raise_error(F.concat(F.lit("a file that was not listed: "), "_file")).cast("long")
        raw = raw.withColumn("_rank", F.coalesce("_rank", missing))
    else:
        raw = raw.withColumn("_rank", F.lit(0))
    # Fields of a corrupt line: the commas outside of quotes.
    bare = F.regexp_replace(F.col(CORRUPT), '"([^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    # Spark wants a column of the row itself read beside the corrupt line; a length is never negative.
    is_corrupt = F.col(CORRUPT).isNotNull() | (F.length(F.col(f"`{names[0]}`")) < 0)
    problem = F.when(is_corrupt, F.when(fields > len(names), "long").otherwise("short"))
    rows = raw.select(
        *[F.col(f"`{name}`") for name in K.SOURCE_COLUMNS],
        (F.col("_rank") * IN_FILE + F.col("_block") + F.col("_nth")).alias("src_row"),
        problem.alias("problem"),
        "_file",
    )
    if strict:
        message = F.concat(F.lit("malformed row in "), "_file", F.lit(": it is too "), "problem")
        stops = F.raise_error(message).cast("boolean")
        rows = rows.where(F.when(F.col("problem").isNotNull(), stops).otherwise(F.lit(True))).drop("problem")
    return rows.drop("_file")


MALFORMED = ("short", "long")


def malformed(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows of a feed that was not read strictly, and the counts of malformed ones once they have been computed."""
    seen = Observation("feed")
    return raw.observe(seen, *[F.count_if(F.col("problem") == kind).alias(f"{kind}_rows") for kind in MALFORMED]), seen


def rename(raw: DataFrame) -> DataFrame:
    """Source headers to canonical names; ``src_row`` is carried along."""
    return raw.select(*[F.col(f"`{source}`").alias(name) for source, name in K.SOURCE_COLUMNS.items()], "src_row")
