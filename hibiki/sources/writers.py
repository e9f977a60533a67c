"""Writers: partitioned tables, and the renderings that the corpus uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hibiki.operators import ledger
from hibiki.operators.boundary import now_utc

from . import readers


def part_text(paras: DataFrame) -> DataFrame:
    """part_id, side, text: a part's paragraphs a line each, blank ones as empty lines."""
    line = F.when(F.coalesce("kind", F.lit("")) == "blank", "").otherwise(F.coalesce("text", F.lit("")))
    return paras.withColumn("line", line).groupBy("part_id", "side").agg(F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY para_index)").alias("text"))


def write_parts(paras: DataFrame, path: str) -> None:
    """One JSON object a part and side."""
    packed = paras.groupBy(F.col("part_id").alias("id"), "side").agg(F.sort_array(F.collect_list(F.struct(F.col("para_index").cast("int").alias("index"), "kind", "text"))).alias("paragraphs"))
    packed.write.mode("overwrite").json(path)


def write_by(df: DataFrame, path: str, column: str) -> None:
    """A partition a value; only the partitions that come are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def append_index(rows: DataFrame, path: str, key: str = "part_id") -> int:
    """Append the rows of parts that the index doesn't hold; their number comes back.

    The row ids go on from the greatest there; they follow sorted keys, so they don't depend on the order of work.
    """
    spark = rows.sparkSession
    if readers.exists(spark, path):
        old = spark.read.parquet(path)
        rows = rows.join(old.select(key).distinct(), key, "left_anti")
        top = old.agg(F.max("row_id")).first()[0]
        start = -1 if top is None else top
    else:
        start = -1
    # places within a part, and the start of each part: no window over all rows
    sized = rows.groupBy(key).agg(F.count("*").alias("_n"))
    starts = sized.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    others = [c for c in rows.columns if c != key]
    numbered = rows.join(starts, key).withColumn("row_id", F.lit(start) + F.col("_start") + F.row_number().over(Window.partitionBy(key).orderBy(*others))).drop("_start")
    numbered = numbered.select("row_id", *rows.columns)
    n = numbered.count()
    if n:
        numbered.write.mode("append").parquet(path)
    return n


def append_unique(df: DataFrame, path: str, key: str) -> None:
    """Append rows; a key that is there already, or comes twice, is an error and nothing is written."""
    spark = df.sparkSession
    twice = df.groupBy(key).count().where("count > 1").limit(1).count()
    if twice or (readers.exists(spark, path) and df.join(spark.read.parquet(path), key, "left_semi").limit(1).count()):
        raise ValueError(f"duplicate {key}")
    df.write.mode("append").parquet(path)


def promote(manifest: DataFrame, part_id: str, en_text: str | None = None, source: DataFrame | None = None, model: str | None = None, suffix: str | None = None, meta: DataFrame | None = None) -> DataFrame:
    """The manifest with a part's entry put in or replaced. Exactly one of en_text and source (rows with text) must be given;
    a model that isn't given is that of the sibling meta (rows with model), if there is one."""
    if (en_text is None) == (source is None):
        raise ValueError("give either en_text or source")
    spark = manifest.sparkSession
    body = spark.createDataFrame([(en_text,)], "text string") if source is None else source.select("text").limit(1)
    if meta is not None and model is None:
        body = body.join(meta.agg(F.first("model", ignorenulls=True).alias("_m")), F.lit(True))
    else:
        body = body.withColumn("_m", F.lit(model).cast("string"))
    new = body.select(F.lit(part_id).alias("part_id"), F.col("text").alias("en_text"), F.col("_m").alias("model"), F.lit(suffix).cast("string").alias("source_suffix"), now_utc().alias("promoted_at"))
    return ledger.upserted(manifest, new.select(*[c if c in new.columns else F.lit(None).alias(c) for c in manifest.columns]), "part_id")


def demote(manifest: DataFrame, part_id: str) -> DataFrame:
    return manifest.where(F.col("part_id") != part_id)


def deviation_ids(rows: DataFrame) -> DataFrame:
    """rows + id: part-NNN-rNN-dNN, numbered within part and round."""
    w = Window.partitionBy("part_id", "round").orderBy("idx")
    number = F.regexp_extract("part_id", r"^part_(\d+)$", 1)
    return rows.withColumn("id", F.format_string("part-%s-r%02d-d%02d", number, F.col("round"), F.row_number().over(w)))


def markdown_cell(x: Column | str) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def markdown_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """line: a Markdown table line a row."""
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[markdown_cell(c) for c in columns]), F.lit(" |")).alias("line"))


def write_texts(rows: DataFrame, root: str, path: str = "path", text: str = "text", missing_only: bool = False) -> None:
    """A file a row, in place of what is there; with missing_only files that are there stay (a scaffold that can be run again).

    Each task writes its own rows through the root's file system; a file is written beside its place and then moved
    there, so a repeated task gives the same files. For notes and reports: many small texts that people read.
    """
    from pyarrow import fs

    def put(batches):
        files, base = fs.FileSystem.from_uri(root)
        for pdf in batches:
            for p, t in zip(pdf["p"], pdf["t"]):
                if ".." in p.split("/"):
                    raise ValueError(f"path outside the root: {p}")
                target = f"{base}/{p}"
                if missing_only and files.get_file_info(target).type != fs.FileType.NotFound:
                    continue
                files.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with files.open_output_stream(target + ".part") as f:
                    f.write((t or "").encode())
                files.move(target + ".part", target)
            yield pdf[["p"]].iloc[:0]

    rows.select(F.col(path).alias("p"), F.col(text).alias("t")).mapInPandas(put, "p string").write.format("noop").mode("overwrite").save()


def write_rules(rules: DataFrame, root: str) -> None:
    """Rule notes in the folder of their state. rules: the columns of notes.rule_note()."""
    from hibiki.operators import notes

    write_texts(rules.select(F.concat(F.col("state"), F.lit("/"), F.col("id"), F.lit(".md")).alias("path"), notes.rule_note().alias("text")), root)


def write_issues(issues: DataFrame, path: str) -> None:
    """One folder of JSON lines a part; parts that have no issues any more go (the whole ledger is replaced)."""
    issues.orderBy("part_id", "id").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part_id").json(path)


def write_run(results: DataFrame, path: str) -> None:
    """A run's verdicts under its label; other labels stay."""
    write_by(results, path, "label")


def write_report(rows: DataFrame, root: str, label: str, baseline: str | None = None) -> None:
    """A report as Markdown and as JSON, named by its label and baseline. rows: what scores.report_rows() gives; a report is a page that people read."""
    name = label + (f"-vs-{baseline}" if baseline else "")
    columns = ["part", "issue", "category", "verdict", "baseline_verdict", "change"]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[markdown_cell(c) for c in columns]), F.lit(" |"))
    counts = F.to_json(F.struct(*[F.count_if(F.col("verdict") == v).alias(v) for v in ledger.VERDICTS]))
    of = lambda change: F.array_sort(F.collect_list(F.when(F.col("change") == change, F.col("issue").cast("string"))))
    body = F.expr("listagg(_line, '\n') WITHIN GROUP (ORDER BY part, issue)")
    page = rows.withColumn("_line", line).agg(
        F.concat(F.lit(f"# Report {name}\n\n"), F.lit("| " + " | ".join(columns) + " |\n|" + "---|" * len(columns) + "\n"), F.coalesce(body, F.lit("")), F.lit("\n")).alias("md"),
        F.to_json(
            F.struct(
                F.lit(label).alias("label"), F.lit(baseline).cast("string").alias("baseline"), F.from_json(counts, "map<string, bigint>").alias("counts"), of("regression").alias("regressions"), of("improvement").alias("improvements"),
                F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"),
            )
        ).alias("json"),
    )
    files = page.select(F.explode(F.array(F.struct(F.lit(f"{name}.md").alias("path"), F.col("md").alias("text")), F.struct(F.lit(f"{name}.json").alias("path"), F.col("json").alias("text")))).alias("f")).select("f.*")
    write_texts(files, root)


def write_index(pairs: DataFrame, vectors: DataFrame, path: str, model: str, granularity: str) -> None:
    """pairs (row_id ...), vectors (row_id, embedding) and a meta row (rows, dim, model, granularity, built_at), the meta last: an index is there when it is."""
    spark = pairs.sparkSession
    pairs.write.mode("overwrite").parquet(f"{path}/pairs")
    vectors.select("row_id", "embedding").write.mode("overwrite").parquet(f"{path}/vectors")
    v = spark.read.parquet(f"{path}/vectors")
    meta = v.agg(F.count("*").alias("rows"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dim"))
    meta.select("*", F.lit(model).alias("model"), F.lit(granularity).alias("granularity"), now_utc().alias("built_at")).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def write_json(rows: DataFrame, root: str, path: Column, text: str | None = None) -> None:
    """A JSON file a row (a plan, a manifest, a critique): the whole row, or the column that holds the JSON already."""
    body = F.col(text) if text else F.to_json(F.struct(*rows.columns))
    write_texts(rows.select(path.alias("path"), body.alias("text")), root)


def scaffold(spark, root: str, seeds: dict[str, str]) -> None:
    """The files of a new vault; those that are there already stay as they are."""
    write_texts(spark.createDataFrame(list(seeds.items()), "path string, text string"), root, missing_only=True)
