"""Landing zone: nested JSON documents, one or more per neighbourhood and run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake import schemas
from reviewlake.functions.dates import as_of_timestamp
from reviewlake.functions.numeric import ratio
from reviewlake.functions.text import slug
from reviewlake.session import checkpointed

LAYOUTS = {"envelope": schemas.ENVELOPE, "simple": schemas.SIMPLE, None: schemas.LANDING}
PARTITIONS = ("year", "month", "day", "bairro")


CORRUPT = "_corrupt_record"
#: Where a line lies: its file, the start of its split, and its place among the lines of the task.
FILE, BLOCK, AT = "_file", "_block", "_at"


def _lines(spark: SparkSession, path: str, partitions: bool) -> DataFrame:
    """Landed lines as ``value``, with the folder columns if asked for, the file and the place in it."""
    if partitions:
        folders = [f for f in schemas.PARTITIONED_ENVELOPE.fields if f.name in PARTITIONS]
        reader = spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *folders]))
        read = reader.option("basePath", path).text(path)
    else:
        read = spark.read.option("recursiveFileLookup", "true").text(path)
    return read.select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(AT))


def _listed(text: Column) -> Column:
    """A document, or an array of them, as an array."""
    bare = F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))
    return F.when(bare.startswith("[") & bare.endswith("]"), bare).otherwise(F.concat(F.lit("["), bare, F.lit("]")))


def _readable(text: Column) -> Column:
    return F.from_json(_listed(text), "array<struct<schema_version string>>").isNotNull()


def _is_document(line: Column) -> Column:
    """A line that is a whole document, or an array of them, and is not indented."""
    return line.rlike(r"^[\[{]") & _readable(line)


#: A closing bracket and an opening one behind it, outside strings: no JSON text has them within a document.
TOUCHING = r"[}\]]\s*[\[{]"
BORDER = r'\G((?:[^"}\]]++|"(?:[^"\\]++|\\.)*+"|[}\]](?!\s*[\[{]))*+[}\]])\s*(?=[\[{])'


def _parted(line: Column) -> Column:
    """A line cut where one document ends and the next begins."""
    return F.when(line.rlike(TOUCHING), F.split(F.regexp_replace(line, BORDER, "$1\n"), "\n")).otherwise(F.array(line))


def _nesting(line: Column) -> tuple[Column, Column]:
    """By how much a line changes the depth of brackets outside strings, and whether it has any."""
    brackets = F.regexp_replace(F.regexp_replace(line, r'"(?:[^"\\]++|\\.)*+"', ""), r"[^\[\]{}]", "")
    opening = F.length(F.regexp_replace(brackets, r"[\]}]", ""))
    return 2 * opening - F.length(brackets), F.length(brackets) > 0


def _cut(files: DataFrame, by_line: Column) -> DataFrame:
    """The documents (``value``) of files given by their lines (``_lines``, none of them blank).

    Unless a file goes by line, a document ends where all brackets outside strings
    are closed. Where they never are, documents begin at lines that open a bracket
    without being indented.
    """
    others = [c for c in files.columns if c != "_lines"]

    def nesting(line: Column) -> Column:
        change, some = _nesting(line)
        return F.struct(change.alias("change"), some.alias("any"))

    def step(held: Column, line: Column) -> Column:
        depth, n = held["depth"] + line["change"], held["n"] + 1
        closed = (depth <= 0) & line["any"]
        return F.struct(F.when(closed, F.array_append(held["ends"], n)).otherwise(held["ends"]).alias("ends"),
                        F.when(closed, F.lit(0)).otherwise(depth).alias("depth"), n.alias("n"))

    start = F.struct(F.array().cast("array<int>").alias("ends"), F.lit(0).alias("depth"), F.lit(0).alias("n"))
    lines = F.when(by_line, F.col("_lines")).otherwise(F.flatten(F.transform("_lines", _parted)))
    staged = files.where(F.size("_lines") > 0).select(*others, lines.alias("_lines"), by_line.alias("_by_line"))
    every = F.transform("_lines", lambda x, i: i + 1)
    opened = F.filter(F.transform("_lines", lambda x, i: F.when(x.rlike(r"^[\[{]"), i)), lambda i: i > 0)
    staged = staged.withColumn("_walked", F.when(
        ~F.col("_by_line"), F.aggregate(F.transform("_lines", nesting), start, step)))
    ends = (F.when(F.col("_by_line"), every).when(F.col("_walked.depth") == 0, F.col("_walked.ends")).otherwise(opened))
    staged = staged.withColumn("_ends", F.array_union(ends, F.array(F.size("_lines"))))
    staged = staged.withColumn("_starts", F.concat(F.array(F.lit(0)), F.col("_ends")))
    spans = F.arrays_zip(F.slice("_starts", 1, F.size("_ends")).alias("a"), F.col("_ends").alias("b"))
    # The texts are exploded, not the spans: a row per span would carry all lines with it.
    texts = F.transform(spans, lambda x: F.array_join(F.slice("_lines", x["a"] + 1, x["b"] - x["a"]), "\n"))
    return staged.select(*others, F.explode(texts).alias("value")).where(F.trim("value") != "")


def _cut_lines(lines: DataFrame) -> DataFrame:
    """The documents of files that do not go by line, as ``_cut`` finds them, from a row per line.

    The depth of brackets is held as a running sum less its lowest value so far, 0 at most: it never falls below 0.
    A file's lines are passed in order once and can be spilled; only a document's lines are put together.
    """
    others = [c for c in lines.columns if c not in ("value", FILE, BLOCK, AT)]
    parts = lines.select(FILE, BLOCK, AT, *others, F.posexplode(_parted(F.col("value"))).alias("_part", "value"))
    change, some = _nesting(F.col("value"))
    marked = parts.select("*", change.alias("_change"), some.alias("_any"),
                          F.col("value").rlike(r"^[\[{]").cast("int").alias("_opens"))
    line = Window.partitionBy(FILE).orderBy(BLOCK, AT, "_part")
    upto, whole = line.rowsBetween(Window.unboundedPreceding, 0), line.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    depth = F.col("_sum") - F.least(F.lit(0), F.col("_low"))
    walked = (marked.withColumns({"_sum": F.sum("_change").over(upto), "_opened": F.sum("_opens").over(upto)})
              .withColumn("_low", F.min("_sum").over(upto)).withColumn("_depth", depth))
    closed = (F.col("_any") & (F.col("_depth") == 0)).cast("int")
    numbered = walked.withColumns({
        "_ended": F.sum(closed).over(upto) - closed, "_rest": F.last("_depth").over(whole)})
    document = F.when(F.col("_rest") == 0, F.col("_ended")).otherwise(F.col("_opened"))
    rows = F.array_sort(F.collect_list(F.struct(BLOCK, AT, "_part", "value")))
    # Dealt by document: grouped where the file's lines are, all of it would be put together and read by one task.
    dealt = numbered.select(FILE, BLOCK, AT, "_part", "value", *others, document.alias("_document")).repartition(
        FILE, "_document")
    return (dealt.groupBy(FILE, *others, "_document").agg(rows.alias("_rows"))
            .select(*others, F.array_join(F.transform("_rows", lambda r: r["value"]), "\n").alias("value"))
            .where(F.trim("value") != ""))


def _pieces(texts: DataFrame) -> DataFrame:
    """The documents of whole files in ``value``: one per line where most lines are documents, else cut at brackets."""
    others = [c for c in texts.columns if c != "value"]
    lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
    whole = F.size(F.filter("_lines", _is_document))
    return _cut(texts.select(*others, lines.alias("_lines")), (whole > 0) & (2 * whole >= F.size("_lines")))


def _split_pieces(spark: SparkSession, path: str, partitions: bool) -> DataFrame:
    """The documents of all files. Files of lines are read in splits; only the lines of the others are put in order
    again. Which is which is counted per file."""
    lines = _lines(spark, path, partitions).where(F.trim("value") != "")
    others = [c for c in lines.columns if c not in ("value", FILE, BLOCK, AT)]
    spread = lines.groupBy(FILE).agg(
        F.count_if(_is_document(F.col("value"))).alias("_whole"), F.count(F.lit(1)).alias("_all")
    ).where("_whole = 0 or 2 * _whole < _all").select(FILE)
    single = lines.join(spread, FILE, "left_anti").select(*others, "value")
    return single.unionByName(_cut_lines(lines.join(spread, FILE, "left_semi")).select(*others, "value"))


def _parsed(pieces: DataFrame, schema: T.StructType) -> DataFrame:
    others = [c for c in pieces.columns if c != "value"]
    parsed = pieces.select(*others, F.explode_outer(
        F.from_json(_listed(F.col("value")), T.ArrayType(schema))).alias("d"))
    return parsed.select("d.*", *others)


def whole_documents(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Documents of whole files: one or more over many lines, arrays of them, or one per line.

    Nothing after the first document is passed over. What cannot be read comes
    as a row without values (see ``unreadable``).
    """
    return _parsed(_pieces(texts), schema)


def read_landing(spark: SparkSession, path: str, layout: str | None = None,
                 partitions: bool = False, multiline: bool = True) -> DataFrame:
    """Read landed JSON with a fixed schema.

    ``path`` may be a folder, searched recursively, or a glob. With
    ``partitions=True`` the ``year=/month=/day=/bairro=`` folders become columns
    (as ``part_year`` ... ``part_bairro``) and filters on them skip whole folders.

    Files may hold documents over many lines, or one per line as ``write_landing``
    makes them: which is found per file, and files of lines are read in splits.
    ``multiline=False`` is for folders of lines alone and saves that look. An
    unreadable document comes as a row without values; ``unreadable`` lists them.
    """
    if partitions and layout == "simple":
        raise ValueError("partition folders hold envelope documents only")
    if multiline:
        landed = _parsed(
            _split_pieces(spark, path, partitions), schemas.ENVELOPE if partitions else LAYOUTS[layout])
    elif partitions:
        landed = spark.read.schema(schemas.PARTITIONED_ENVELOPE).option("basePath", path).json(path)
    else:
        landed = spark.read.schema(LAYOUTS[layout]).option("recursiveFileLookup", "true").json(path)
    return landed.withColumnsRenamed({p: f"part_{p}" for p in PARTITIONS}) if partitions else landed


def unreadable(spark: SparkSession, path: str, partitions: bool = False, multiline: bool = True) -> DataFrame:
    """The texts of documents that cannot be read, with their folder columns if asked for."""
    value = F.col("value")
    if multiline:
        texts = _split_pieces(spark, path, partitions)
        broken = ~_readable(value)
    else:
        texts = _lines(spark, path, partitions).drop(FILE, BLOCK, AT).where(F.trim("value") != "")
        schema = f"schema_version string, {CORRUPT} string"
        broken = F.from_json(value, schema, {"columnNameOfCorruptRecord": CORRUPT})[CORRUPT].isNotNull()
    found = texts.where(broken)
    return found.withColumnsRenamed({p: f"part_{p}" for p in PARTITIONS}) if partitions else found


def branch_points() -> Column:
    """Completeness points of one branch, at most 6; zero and blank earn nothing."""
    def truthy(c):
        return F.coalesce((c != "").cast("int"), F.lit(0))

    return (
        truthy(F.col("name")) + truthy(F.col("place_id")) + truthy(F.col("formatted_address"))
        + F.coalesce((F.col("rating") != 0).cast("int"), F.lit(0))
        + F.least(F.coalesce(F.size("reviews"), F.lit(0)), F.lit(2))
    )


def build_envelopes(branches: DataFrame, run_id: str, as_of: str | None,
                    chunk: Column, bairro: str = "bairro") -> DataFrame:
    """Wrap branches into envelope documents, one per neighbourhood and ``chunk``.

    ``chunk`` must number runs of rows of a bounded length (``numbered_runs`` does),
    so that no document, and no task building one, has to hold a hot neighbourhood whole.
    """
    now = as_of_timestamp(as_of)
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = [f.name for f in schemas.BRANCH.fields]
    present = [
        (F.col(f.name) if f.name in branches.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.BRANCH.fields
    ]
    typed = branches.select(F.col(bairro).alias("bairro"), chunk.cast("string").alias("_chunk"), *present)
    grouped = typed.groupBy("bairro", "_chunk").agg(
        F.collect_list(F.struct(*fields)).alias("agencias"),
        F.count(F.lit(1)).cast("int").alias("_n"),
        F.sum(F.coalesce(F.size("reviews"), F.lit(0))).cast("int").alias("_reviews"),
        F.sum(branch_points()).alias("_points"),
    )
    return grouped.select(
        F.struct(
            F.concat(F.lit(run_id + "_"), F.col("_chunk")).alias("run_id"),
            stamp.alias("execution_date"),
            F.col("bairro"),
            F.struct(
                F.year(now).alias("year"), F.month(now).alias("month"), F.dayofmonth(now).alias("day")
            ).alias("partition_info"),
            F.struct(
                F.col("_n").alias("total_agencias"), F.col("_reviews").alias("total_reviews"),
                ratio(F.col("_points"), F.col("_n") * 6).alias("completeness_score"),
            ).alias("data_quality"),
            F.struct(
                stamp.alias("timestamp_inicio"),
                F.lit(None).cast("double").alias("tempo_execucao_segundos"),
                F.lit(None).cast("int").alias("quota_utilizada"),
            ).alias("processing_info"),
        ).alias("execution_metadata"),
        F.struct("agencias").alias("raw_data"),
        F.lit("v1.0").alias("schema_version"),
        stamp.alias("created_at"),
    )


def numbered_runs(branches: DataFrame, max_branches: int = 50) -> tuple[DataFrame, Column]:
    """``(rows, chunk)``: rows numbered per input partition and cut into runs of ``max_branches``.

    The numbered rows are checkpointed: a re-run of a lost task must not number them anew.
    """
    numbered = checkpointed(branches.withColumn("_row", F.monotonically_increasing_id()))
    partition = F.shiftright("_row", 33)
    run = F.floor((F.col("_row") - F.shiftleft(partition, 33)) / F.lit(max_branches))
    return numbered, F.concat_ws("_", partition.cast("string"), run.cast("string"))


def write_landing(branches: DataFrame, path: str, run_id: str, as_of: str | None,
                  max_branches: int = 50, bairro: str = "bairro", mode: str = "append") -> None:
    """Write branches as JSON lines of envelope documents below year/month/day/bairro folders.

    No document holds more than ``max_branches``, whatever the skew.
    """
    numbered, chunk = numbered_runs(branches, max_branches)
    docs = build_envelopes(numbered, run_id, as_of, chunk, bairro)
    info = "execution_metadata.partition_info"
    (
        docs.withColumns({
            "year": F.col(f"{info}.year"),
            "month": F.lpad(F.col(f"{info}.month").cast("string"), 2, "0"),
            "day": F.lpad(F.col(f"{info}.day").cast("string"), 2, "0"),
            "bairro": slug(F.col("execution_metadata.bairro")),
        })
        # Few files per folder; a hot neighbourhood is split over several tasks.
        .hint("rebalance", *[F.col(p) for p in PARTITIONS])
        .write.mode(mode).partitionBy(*PARTITIONS).json(path)
    )
