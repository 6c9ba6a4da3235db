"""Company registry dumps: entity catalogue, CSV reading, per-file totals, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.functions.domains import literal_table

# ---------------------------------------------------------------------------
# Entities in order of priority with file count and compressed size in MB.
# ---------------------------------------------------------------------------
CATALOGUE = """
empresas 1 10 1200 Dados cadastrais básicos (CNPJ Base)
estabelecimentos 1 10 4900 Filiais e estabelecimentos (CNPJ Completo)
cnaes 1 1 1 Códigos de atividades econômicas
socios 2 10 590 Quadro societário
simples 2 1 258 Opção pelo Simples Nacional
municipios 3 1 1 Códigos de municípios
naturezas 3 1 1 Naturezas jurídicas
qualificacoes 3 1 1 Qualificações de sócios
paises 3 1 1 Códigos de países
motivos 3 1 1 Motivos de situação cadastral
"""
# The reference lists with a known layout; all other entities get positional names.
CODE_LISTS = ("cnaes", "municipios", "naturezas", "qualificacoes", "paises", "motivos")
CODE_LIST_COLUMNS = ("codigo", "descricao")
LARGE_ABOVE_MB = 100
NULL_TEXTS = ("", "NULL")
# ---------------------------------------------------------------------------


def catalogue(spark: SparkSession) -> DataFrame:
    """The ten entities: priority, file pattern, file count, size, large flag."""
    rows = []
    for order, line in enumerate(CATALOGUE.strip().splitlines()):
        entity, priority, files, size, description = line.split(" ", 4)
        rows.append((order, entity, int(priority), int(files), int(size), description))
    table = literal_table(
        spark, rows, "ordem", "entity", "priority", "num_files", "estimated_size_mb", "descricao"
    )
    stem = F.initcap("entity")
    return table.withColumns({
        "file_pattern": F.when(F.col("num_files") > 1, F.concat(stem, F.lit("{}.zip"))).otherwise(
            F.concat(stem, F.lit(".zip"))),
        "is_large": F.col("estimated_size_mb") > LARGE_ABOVE_MB,
        "is_dimension": F.col("priority") == 3,
    })


def column_names(entity: str, width: int) -> list[str]:
    known = CODE_LIST_COLUMNS if entity in CODE_LISTS else ()
    return list(known) if len(known) == width else [f"col_{i}" for i in range(width)]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of all files with file, byte range, place in the range and number of quotes; ranges are read in parallel."""
    raw = spark.read.format("text").option("lineSep", "\n").load(path)
    decoded = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), decoded.alias("line"),
        (F.char_length(decoded) - F.char_length(F.replace(decoded, F.lit('"')))).alias("quotes"))


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(record string): records of a dump whose quoted fields may hold line breaks, found in parallel within a file.

    A line begins a record when the quotes before it in its file are even. One narrow pass counts quotes per
    byte range; a running sum over the ranges of a file, one row each, gives the parity at every range's
    begin. Then the lines of a range are numbered on their own. A record that runs on into later ranges
    belongs to the last range before them in which a record begins. Lines that are whole records are passed
    on; only the others are gathered, by record. A record is the unit that one task must hold, and a
    range the unit that one task sorts. A quote that is never closed makes the rest of its file one record, as
    it does for any reader of quoted text. Blank lines outside quotes are no records.
    """
    lines = _lines(spark, path)
    odd = F.col("quotes") % 2 == 1
    ranges = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.min(F.when(odd, F.col("at"))).alias("first_odd"), F.max("at").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    # In a range that begins inside quotes, a record begins behind the first line that closes them.
    begins = (F.col("before") == 0) | F.coalesce(F.col("first_odd") < F.col("last"), F.lit(False))
    ranges = ranges.withColumn("owner", F.last(F.when(begins, F.col("block")), ignorenulls=True).over(earlier))
    within = Window.partitionBy("file", "block").orderBy("at")
    so_far = F.sum("quotes").over(within.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    placed = lines.join(ranges.select("file", "block", "before", "owner"), ["file", "block"]).withColumn("after", so_far % 2)
    start = (F.col("after") + F.col("quotes")) % 2 == 0
    placed = placed.withColumn("start", start.cast("long")).withColumn(
        "number", F.sum("start").over(within.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "later", F.sum("start").over(Window.partitionBy("file", "block")) - F.col("number"))
    whole = (F.col("start") == 1) & (F.col("after") == 0)
    inherited = F.col("number") == 0
    pieces = placed.where(~whole).select(
        "file", F.when(inherited, F.col("owner")).otherwise(F.col("block")).alias("owner"),
        F.when(inherited, F.lit(0)).otherwise(F.col("later")).alias("later"), F.struct("block", "at", "line").alias("piece"))
    gathered = pieces.groupBy("file", "owner", "later").agg(F.array_sort(F.collect_list("piece")).alias("pieces")).select(
        F.array_join(F.transform("pieces", lambda p: p["line"]), "\n").alias("record"))
    single = placed.where(whole & (F.rtrim("line", F.lit("\r")) != "")).select(F.col("line").alias("record"))
    return single.unionByName(gathered).select(F.regexp_replace("record", "\r$", "").alias("record"))


def read_registry(
    spark: SparkSession, path: str | list[str], entity: str, multi_line: bool = True
) -> DataFrame:
    """A headerless semicolon dump in ISO-8859-1; every column is text.

    Quotes double inside quotes (a backslash is plain text) and may hold line breaks; files are read in
    byte ranges either way (see ``quoted_records``). Dumps known to have no breaks inside quotes save a
    shuffle with ``multi_line=False``.
    """
    options = {"sep": ";", "quote": '"', "escape": '"'}
    if multi_line:
        records = quoted_records(spark, path)
        first = records.head()
        if first is None:
            return spark.createDataFrame([], ", ".join(f"{c} string" for c in column_names(entity, 2)))
        fields = spark.range(1).select(F.schema_of_csv(F.lit(first.record), options).alias("s")).head().s
        width = len(T.StructType.fromDDL(fields.removeprefix("STRUCT<").removesuffix(">")).fields)
        schema = ", ".join(f"_c{i} STRING" for i in range(width))
        raw = records.select(F.from_csv("record", schema, options).alias("r")).select("r.*")
    else:
        raw = spark.read.csv(path, encoding="ISO-8859-1", header=False, inferSchema=False, **options)
    names = column_names(entity, len(raw.columns))
    return raw.select(*(
        F.when(~F.col(old).isin(*NULL_TEXTS), F.col(old)).alias(new) for old, new in zip(raw.columns, names)
    ))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count of each file behind a file-based frame."""
    return df.select(F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count("*").alias("rows"))


def ingest_summary(per_file: DataFrame, expected: DataFrame) -> DataFrame:
    """Files, successes, failures and rows per entity.

    ``per_file`` has ``entity, rows``; ``expected`` has ``entity, num_files``. A file without rows
    counts as failed, like one that never arrived.
    """
    seen = per_file.where("rows > 0").groupBy("entity").agg(
        F.count("*").alias("successes"), F.sum("rows").alias("total_rows")
    )
    joined = expected.select("entity", F.col("num_files").alias("total_files")).join(seen, "entity", "left")
    return joined.fillna(0, ["successes", "total_rows"]).withColumn(
        "failures", F.col("total_files") - F.col("successes")
    )


def ingest_totals(summary: DataFrame) -> DataFrame:
    """Run totals over entities."""
    return summary.agg(
        F.sum("total_files").alias("total_files"),
        F.sum("successes").alias("successes"),
        F.sum("failures").alias("failures"),
        F.sum("total_rows").alias("total_rows"),
    )


def versions_in(listing: Column) -> Column:
    """All ``YYYY-MM/`` folder names in a directory listing text."""
    return F.regexp_extract_all(listing, F.lit(r"(\d{4}-\d{2})/"), F.lit(1))


def latest_version(listings: DataFrame, text: str) -> DataFrame:
    """Greatest version of all listings as one row, null when there is none."""
    newest = F.array_max(versions_in(F.col(text)))
    return listings.agg(F.max(newest).alias("latest"))


def version_check(current: DataFrame, latest: DataFrame) -> DataFrame:
    """``needs_update, current, latest`` from two one-column frames of versions.

    Without a latest version nothing is due; without a current one everything is.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("side"), F.col(df.columns[0]).alias("version"))

    both = side(current, "current").unionAll(side(latest, "latest")).agg(
        F.max(F.when(F.col("side") == "current", F.col("version"))).alias("current"),
        F.max(F.when(F.col("side") == "latest", F.col("version"))).alias("latest"),
    )
    due = F.col("latest").isNotNull() & (F.col("current").isNull() | (F.col("current") != F.col("latest")))
    return both.withColumn("needs_update", due)
