"""The source files: splits from file names, image names and bytes, labels; which images still need work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "test", "validation")


def split_of_file(name: Column) -> Column:
    """Split from a file's base name: train, test, val; the first that it contains; else others."""
    base = F.lower(F.substring_index(name, "/", -1))
    return F.when(base.contains("train"), "train").when(base.contains("test"), "test").when(base.contains("val"), "validation").otherwise("others")


def image_bytes(df: DataFrame, column: str = "image") -> Column:
    """Bytes of an image that is stored raw or in a struct; null for other types."""
    kind = df.schema[column].dataType.typeName()
    if kind == "struct":
        return F.col(f"{column}.bytes")
    return F.col(column) if kind == "binary" else F.lit(None).cast("binary")


def image_name(question_id: Column, doc_id: Column, split: Column, row: Column) -> Column:
    """Name after the question, else after the document and row, else after the split and row."""
    text = lambda c: c.cast("string")
    return F.coalesce(F.concat(text(question_id), F.lit(".png")), F.concat(text(doc_id), F.lit("_"), text(row), F.lit(".png")), F.concat(split, F.lit("_"), text(row), F.lit(".png")))


def with_file_rows(df: DataFrame, file_name: str, *order: str) -> DataFrame:
    """Adds ``row``, the place within the source file, counted from 0 in the given order. Files bound the groups."""
    return df.withColumn("row", F.row_number().over(Window.partitionBy(file_name).orderBy(*order)) - 1)


def labels(df: DataFrame) -> DataFrame:
    """The labels of each question, without the image column, so that a scan never reads it."""
    split = split_of_file(F.col("file_name"))
    name = image_name(F.col("questionid"), F.col("docid"), split, F.col("row"))
    path = F.concat_ws("/", split, name)
    return df.select(F.col("questionid").alias("question_id"), "question", F.col("docid").alias("doc_id"), split.alias("split"), name.alias("image_filename"), path.alias("image_path"), F.to_json("answers").alias("answers"))


def split_counts(df: DataFrame, split: Column) -> DataFrame:
    """Rows of each of the three splits, 0 where there are none."""
    spark = df.sparkSession
    every = spark.createDataFrame([(s,) for s in SPLITS], "split string")
    return every.join(df.groupBy(split.alias("split")).agg(F.count("*").alias("n")), "split", "left").fillna(0, ["n"])


def first_of_split(df: DataFrame, split: str, order: str, most: int) -> DataFrame:
    """The first rows of each split by name; ranks are cut off before they are shuffled."""
    w = Window.partitionBy(split).orderBy(order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).drop("_r")


def random_rows(df: DataFrame, most: int, seed: int) -> DataFrame:
    """Some rows by chance; the same ones for the same seed and partitions. Each task keeps its best ``most`` before they are merged."""
    return df.orderBy(F.rand(seed)).limit(most)


def still_to_do(images: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Images without a valid output."""
    return images.join(done.select(key).distinct(), key, "left_anti")


def read_parquet(spark, path: str, *columns: str, schema=None) -> DataFrame:
    """Parquet files of a folder; unreadable ones are skipped, only the named columns are read, ``file`` is the base name of each row's file.

    Without a schema it is taken from one file, which must be readable then."""
    reader = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    df = (reader.schema(schema) if schema else reader).parquet(path)
    df = df.select("*", F.col("_metadata.file_name").alias("file"))
    return df.select(*columns, "file") if columns else df


def read_images(spark, path: str, suffix: str = "*.png") -> DataFrame:
    """Image files of a folder with their split (from the path's last folder) and bytes."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", suffix).option("recursiveFileLookup", "true").load(path)
    return df.select("path", F.element_at(F.split("path", "/"), -2).alias("split"), F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content")


def read_json_documents(spark, path: str, leave_out: str = "dataset_statistics.json") -> DataFrame:
    """Whole JSON files as text, by file name, apart from the statistics file."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("payload")).filter(F.col("file_name") != leave_out)


def read_csv(spark, path: str, schema: str) -> DataFrame:
    """CSV files as ``write_csv`` writes them; a partition column may be among the columns."""
    return spark.read.option("header", "true").option("quote", '"').option("escape", '"').option("multiLine", "true").schema(schema).csv(path)


def read_templates(spark, path: str) -> DataFrame:
    """Prompt templates of a JSON file: (template, reasoning_type, prompt_template, system_prompt)."""
    kind = "system_prompt string, prompt_templates map<string, struct<reasoning_type: string, prompt_template: string>>"
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("j"))
    return text.select("j.system_prompt", F.explode("j.prompt_templates").alias("template", "t")).select("template", "t.*", "system_prompt")


_REGION = "array<struct<region_type: string, score: double, block: struct<bbox: array<array<double>>, lines: array<struct<text: string>>>>>"


def regions_of_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Regions of stored results: those of ``layout``, else those at the top, else none. Adds node_id, region_type, bbox, score and text."""
    j = F.from_json(F.col(payload), f"layout struct<regions: {_REGION}>, regions {_REGION}")
    rows = df.withColumn("_j", j).select(*df.columns, F.posexplode(F.coalesce("_j.layout.regions", "_j.regions", F.array().cast(_REGION))).alias("node_id", "_r"))
    return rows.select(*df.columns, "node_id", F.col("_r.region_type").alias("region_type"), F.col("_r.block.bbox").alias("bbox"), F.col("_r.score").alias("score"), F.array_join("_r.block.lines.text", "\n").alias("text")).drop(payload)


# The regions of the demonstration page.
DEMO_REGIONS = (
    ("TextBlock", 50.0, 50.0, 300.0, 100.0, 0.95, "Document Title: Annual Report 2024"),
    ("TextBlock", 50.0, 120.0, 200.0, 160.0, 0.92, "Table 1: Quarterly Sales Figures"),
    ("Table", 50.0, 180.0, 350.0, 350.0, 0.88, "Q1: $1.2M | Q2: $1.5M | Q3: $1.8M | Q4: $2.1M"),
    ("TextBlock", 400.0, 50.0, 550.0, 100.0, 0.90, "Figure 1: Sales Growth Chart"),
    ("Figure", 400.0, 120.0, 650.0, 350.0, 0.85, "[Chart Image]"),
    ("TextBlock", 50.0, 380.0, 650.0, 450.0, 0.93, "The sales figures show consistent growth across all quarters..."),
)


def demo_regions(spark) -> DataFrame:
    """The demonstration page as graph nodes."""
    rows = [("demo", 1, k, *r, False) for k, r in enumerate(DEMO_REGIONS)]
    return spark.createDataFrame(rows, "doc_id string, page_no int, node_id int, region_type string, xmin double, ymin double, xmax double, ymax double, score double, text string, is_short boolean")
