"""Readers: every source has its schema given, and its own policy for bad input."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hibiki.functions import text as T
from hibiki.functions.plan import guarded

TOC = (
    "id string, kind string, part_number int, chapter_number int, chapter_subnumber double, volume_number int, pov string, title_en string, url_en string, url_jp string, "
    "chapter_title_en string, chapter_title_jp string, read_after_part int, mapping_confidence string, notes string"
)
PART = "id string, side string, source_url string, title_native string, paragraphs array<struct<index: int, kind: string, text: string>>"
HOLDOUT = "seed int, target_count int, part_ids array<string>, per_bucket_counts map<string, map<string, int>>"
ISSUE = (
    "id string, part_id string, category string, user_comment string, severity string, first_seen_suffix string, jp_anchor string, en_excerpt_original string, preferred_fix string, "
    "resolution_guidance string, enabled boolean, source string, created_at string, notes string"
)
RUN = "label string, checker string, model string, output_suffix string, checked_at string, results map<string, struct<issue_id: string, verdict: string, evidence: string, reason: string, confidence: string>>"
MANIFEST = "map<string, struct<part_id: string, en_text: string, model: string, source_suffix: string, promoted_at: string>>"


def toc(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array; anything malformed fails. file_pos keeps the order of the file."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", f"array<struct<{TOC.replace(' string', ': string').replace(' int', ': int').replace(' double', ': double')}>>", {"mode": "FAILFAST"})).alias("file_pos", "e"))
    return rows.select("file_pos", "e.*")


def parts(spark: SparkSession, path: str) -> DataFrame:
    """Part files, one JSON object each; a corrupt file gives a row of nulls with its name."""
    return spark.read.schema(PART + ", _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("file", F.col("_metadata.file_name"))


def paragraphs(part_rows: DataFrame) -> DataFrame:
    """Part files in normal form: part_id, side, para_index, kind, text."""
    return part_rows.where("id is not null").select(F.col("id").alias("part_id"), "side", F.explode("paragraphs").alias("p")).select("part_id", "side", F.col("p.index").alias("para_index"), "p.kind", "p.text")


def texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """file, text: whole files."""
    return spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON; blank lines and # lines are skipped, a bad line fails."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)"))
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def issues(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, ISSUE)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """label, issue_id, verdict, ...: the result map of every run as rows."""
    r = spark.read.schema(RUN).option("multiLine", True).json(path)
    return r.select("label", "model", F.explode("results").alias("issue", "v")).select("label", "model", F.coalesce("v.issue_id", "issue").alias("issue_id"), "v.verdict", "v.evidence", "v.reason", "v.confidence")


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """chat, turn, role, text of JSONL turns; content may be a string or a list of parts; bad lines are skipped.

    Files below a folder named subagents don't count.
    """
    # a chat is read whole, so that its turns keep the order of the file
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(path, wholetext=True)
    whole = whole.select(F.col("_metadata.file_path").alias("chat"), "value").where(~F.col("chat").contains("/subagents/"))
    lines = whole.select("chat", F.posexplode(F.split("value", "\r?\n")).alias("_at", "value"))
    v = lines.withColumn("j", F.try_parse_json("value")).where("j is not null")
    string = F.try_variant_get("j", "$.message.content", "string")
    listed = F.try_variant_get("j", "$.message.content", "array<struct<type: string, text: string>>")
    text = F.when(listed.isNotNull(), F.array_join(F.transform(listed, lambda p: p["text"]), "\n")).otherwise(string)
    rows = v.select("chat", "_at", F.try_variant_get("j", "$.role", "string").alias("role"), text.alias("text")).where("text is not null")
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy("chat").orderBy("_at")) - 1).drop("_at")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a JSON object keyed by part; a missing file is an empty manifest."""
    if not exists(spark, path):
        rows = spark.createDataFrame([], "value string")
    else:
        rows = spark.read.text(path, wholetext=True)
    return rows.select(F.explode(F.from_json("value", MANIFEST)).alias("key", "m")).select("key", "m.*")


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """id, episode of a JSON object; a missing file or one that doesn't parse gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "id string, episode string")
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, string>")).alias("id", "episode"))


def index(spark: SparkSession, path: str) -> DataFrame | None:
    """row_id, the pair's columns and embedding of an index folder (pairs, vectors, meta); None unless all three are there.

    As many pairs as vectors, and as many as the meta row says, or reading fails.
    """
    if not all(exists(spark, f"{path}/{x}") for x in ("pairs", "vectors", "meta")):
        return None
    pairs, vectors, meta = (spark.read.parquet(f"{path}/{x}") for x in ("pairs", "vectors", "meta"))
    both = pairs.join(vectors, "row_id", "full")
    odd = both.agg(F.count_if(pairs["row_id"].isNull() | vectors["row_id"].isNull()).alias("odd"), F.count("*").alias("n")).join(meta.select(F.col("rows").alias("said")), F.lit(True))
    return guarded(pairs.join(vectors, "row_id"), odd, (F.col("odd") == 0) & (F.col("n") == F.col("said")), f"{path}: pairs and vectors don't match")


def index_exists(spark: SparkSession, path: str) -> bool:
    """The index is there and holds a row."""
    return all(exists(spark, f"{path}/{x}") for x in ("pairs", "vectors", "meta")) and not spark.read.parquet(f"{path}/vectors").isEmpty()


def part_texts(spark: SparkSession, path: str, part_id: str) -> DataFrame:
    """side, text of one part's files (<id>.<side>.txt); a part without its source side is an error."""
    rows = texts(spark, path).withColumn("_f", F.regexp_extract("file", r"([^/]+)\.([a-z]+)\.txt$", 1)).withColumn("side", F.regexp_extract("file", r"([^/]+)\.([a-z]+)\.txt$", 2)).where(F.col("_f") == part_id)
    return guarded(rows.select("side", "text"), rows.agg(F.count_if(F.col("side") == "jp").alias("n")), F.col("n") > 0, f"{part_id}: no source text")


def style_dimensions(files: DataFrame) -> DataFrame:
    """number, slug, name, body, extracted_through, n_chapters, extracted_at, model of the notes whose file name has the form NN-slug.md.

    files: what notes() gives. What a file lacks of the last four comes from the first that has it.
    """
    form = r"(?:^|/)(\d{2})-([a-z0-9][a-z0-9-]*)\.md$"
    m = lambda k: F.try_element_at("meta", F.lit(k))
    rows = files.where(F.col("path").rlike(form)).select(
        F.regexp_extract("path", form, 1).cast("int").alias("number"), F.regexp_extract("path", form, 2).alias("slug"), m("dimension").alias("name"), T.trimmed("body").alias("body"),
        *[m(k).alias(k) for k in ("extracted_through", "n_chapters", "extracted_at", "model")],
    )
    shared = rows.agg(*[F.min_by(k, F.when(F.col(k).isNotNull(), F.struct("number", "slug"))).alias(f"_{k}") for k in ("extracted_through", "n_chapters", "extracted_at", "model")])
    j = rows.join(shared, F.lit(True))
    return j.select("number", "slug", "name", "body", *[F.coalesce(k, f"_{k}").alias(k) for k in ("extracted_through", "n_chapters", "extracted_at", "model")])


def cached_pages(spark: SparkSession, path: str) -> DataFrame:
    """bucket, name, html of a page cache (bucket/name.html): what fetching would give, read as a table."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").text(path, wholetext=True)
    return rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([^/]+)$", 1).alias("bucket"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([^/]+)$", 2).alias("name"), F.col("value").alias("html"))


def holdout(spark: SparkSession, path: str, target: int = 30, seed: int = 7) -> DataFrame:
    """Defaults stand in for missing keys."""
    h = spark.read.schema(HOLDOUT).option("multiLine", True).json(path)
    return h.select(F.coalesce("seed", F.lit(seed)).alias("seed"), F.coalesce("target_count", F.lit(target)).alias("target_count"), F.coalesce("part_ids", F.array().cast("array<string>")).alias("part_ids"), "per_bucket_counts")


def notes(spark: SparkSession, path: str) -> DataFrame:
    """path, meta map, body of Markdown notes with front matter. A note whose front matter doesn't parse is skipped."""
    import yaml

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for file, text in zip(pdf["file"], pdf["text"]):
                m = re.match(r"---\s*\n(.*?)\n---\s*\n?(.*)", text or "", re.S)
                try:
                    meta = yaml.safe_load(m[1]) if m else {}
                except yaml.YAMLError:
                    continue
                if not isinstance(meta, dict):
                    continue
                flat = {str(k): ",".join(map(str, v)) if isinstance(v, list) else str(v) for k, v in meta.items() if v is not None}
                out.append((file, flat, m[2] if m else text or ""))
            yield pd.DataFrame(out, columns=["path", "meta", "body"])

    return texts(spark, path, "*.md").mapInPandas(parse, "path string, meta map<string, string>, body string")


def rules(note_rows: DataFrame, state: str | None = None) -> DataFrame:
    """id, state, priority, scopes, text, extra of rule notes, by falling priority; a note without state is a candidate."""
    body = T.trimmed(F.regexp_replace("body", r"^\s*#[^\n]*\n", ""))
    m = lambda k: F.try_element_at("meta", F.lit(k))
    out = note_rows.where(m("id").isNotNull()).select(
        m("id").alias("id"),
        F.coalesce(m("state"), F.lit("candidate")).alias("state"),
        F.coalesce(m("priority").try_cast("int"), F.lit(0)).alias("priority"),
        F.split(F.coalesce(m("pov_scope"), F.lit("")), ",").alias("pov_scope"),
        F.split(body, r"\n\s*\n", 2).alias("b"),
    )
    out = out.select("id", "state", "priority", "pov_scope", F.trim(F.try_element_at("b", F.lit(1))).alias("text"), F.coalesce(F.trim(F.try_element_at("b", F.lit(2))), F.lit("")).alias("extra"))
    return (out.where(F.col("state") == state) if state else out).orderBy(F.desc("priority"), "id")


def markdown_tables(files: DataFrame, header: str) -> DataFrame:
    """file, row, cells: the rows of tables whose header line matches; a separator line must follow it.

    Short rows and rows of dashes are left out. Works on lines, so any number of files is one plan.
    """
    lines = files.select("file", F.posexplode(F.split("text", "\n")).alias("row", "line"))
    w = Window.partitionBy("file").orderBy("row")
    dash = F.trim("line").rlike(r"^\|[\s:|-]+\|$")
    starts = F.col("line").rlike(header) & F.coalesce(F.lead(dash).over(w), F.lit(False))
    lines = lines.withColumn("table", F.count_if(starts).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", starts).withColumn("dash", dash)
    bars = F.trim("line").startswith("|")
    lines = lines.withColumn("gap", F.count_if(~bars).over(Window.partitionBy("file", "table").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)))
    kept = lines.where("table > 0 and not start and not dash and gap = 0")
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"(?<!\\)\|"), lambda c: F.trim(c))
    return kept.select("file", "row", cells.alias("cells"))


def glossary(spark: SparkSession, path: str, header: str = r"(?i)^\|\s*Japanese\s*\|") -> DataFrame:
    """japanese, english, notes of Markdown tables; a dash is no note."""
    rows = markdown_tables(texts(spark, path, "*.md"), header).where(F.size("cells") >= 2)
    note = F.try_element_at("cells", F.lit(3))
    return rows.select(F.col("cells")[0].alias("japanese"), F.col("cells")[1].alias("english"), F.when(~note.isin("-", "–", "—", ""), note).alias("notes")).where("japanese <> '' and japanese not in ('-', '—')")


class _Paragraphs(HTMLParser):
    """Text of the paragraphs inside one container: ruby readings dropped, br as a line break."""

    def __init__(self, container: str) -> None:
        super().__init__(convert_charrefs=True)
        self.container, self.depth, self.skip, self.open = container, 0, 0, False
        self.rows: list[tuple[str, str]] = []
        self.title = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag == "meta" and a.get("property") == "og:title":
            self.title = a.get("content") or ""
        if self.depth or self.container in (a.get("class") or "").split():
            if tag not in ("br", "img", "hr", "meta", "input", "link"):
                self.depth += 1
            if tag in ("rt", "rp", "script", "style"):
                self.skip += 1
            elif tag == "p":
                self.rows.append(("", a.get("class") or ""))
                self.open = True
            elif tag == "br" and self.open:
                self._add("\n")

    def handle_endtag(self, tag: str) -> None:
        if self.depth:
            self.depth -= 1
            if tag in ("rt", "rp", "script", "style"):
                self.skip = max(0, self.skip - 1)
            elif tag == "p":
                self.open = False

    def handle_data(self, data: str) -> None:
        if self.depth and self.open and not self.skip:
            self._add(data)

    def _add(self, s: str) -> None:
        text, kind = self.rows[-1]
        self.rows[-1] = (text + s, kind)


def page_paragraphs(pages: DataFrame, key: str, html: str, container: str, navigation: str = r"^(?:Previous|Next|Table of Contents)\b") -> DataFrame:
    """key, idx, kind, text: the paragraphs of a page's container; indents stripped, navigation lines left out."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nav = re.compile(navigation)
        for pdf in batches:
            out = []
            for k, h in zip(pdf["k"], pdf["h"]):
                p = _Paragraphs(container)
                p.feed(h or "")
                i = 0
                for text, css in p.rows:
                    t = text.strip("　\xa0 \t\r\n")
                    if nav.match(t):
                        continue
                    kind = "blank" if not t or "blank" in css.split() else "dialogue" if t[0] in "「『“\"" else "narration"
                    out.append((k, i, kind, "" if kind == "blank" else t))
                    i += 1
            yield pd.DataFrame(out, columns=["k", "idx", "kind", "text"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(F.col(key).alias("k"), F.col(html).alias("h")).mapInPandas(parse, f"k {kind}, idx int, kind string, text string").withColumnRenamed("k", key)


class _Blocks(HTMLParser):
    """The blocks (paragraphs and headings) inside one container, numbered from 0, with their text and links."""

    def __init__(self, container: str) -> None:
        super().__init__(convert_charrefs=True)
        self.container, self.depth, self.block, self.link = container, 0, None, None
        self.blocks: list[tuple[list[str], list[list]]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag in ("br", "img", "hr", "meta", "input", "link"):
            return
        if self.depth or self.container in (a.get("class") or "").split():
            self.depth += 1
            if tag in ("p", "h2", "h3"):
                self.blocks.append(([], []))
                self.block = self.blocks[-1]
            elif tag == "a" and self.block and a.get("href"):
                self.link = [a["href"], []]
                self.block[1].append(self.link)

    def handle_endtag(self, tag: str) -> None:
        if self.depth:
            self.depth -= 1
            if tag in ("p", "h2", "h3"):
                self.block = None
            elif tag == "a":
                self.link = None

    def handle_data(self, data: str) -> None:
        if self.block and data.strip():
            self.block[0].append(data.strip())
            if self.link:
                self.link[1].append(data.strip())


def contents_links(pages: DataFrame, key: str, html: str, container: str, hosts: list[str], break_text: str) -> tuple[DataFrame, DataFrame]:
    """(page, block_index, pos, label, href, block), (page, block_index): the story links of contents pages, and the blocks
    that say where a volume ends. Links count by a host in their address; pages are parsed a batch at a time."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends = re.compile(break_text)
        for pdf in batches:
            out = []
            for k, h in zip(pdf["k"], pdf["h"]):
                p = _Blocks(container)
                p.feed(h or "")
                pos = 0
                for i, (text, found) in enumerate(p.blocks):
                    block = " ".join(text)
                    if ends.search(block):
                        out.append((k, i, -1, None, None, None))
                        continue
                    for href, label in found:
                        if href.startswith("http") and any(x in href for x in hosts):
                            out.append((k, i, pos, "".join(label), href, block))
                            pos += 1
            yield pd.DataFrame(out, columns=["page", "block_index", "pos", "label", "href", "block"])

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("k"), F.col(html).alias("h")).mapInPandas(parse, f"page {kind}, block_index int, pos int, label string, href string, block string")
    return rows.where("pos >= 0"), rows.where("pos < 0").select("page", "block_index")


def page_links(pages: DataFrame, key: str, html: str, hosts: list[str]) -> DataFrame:
    """key, idx, href, label: the links to listed hosts, in order; a pure SQL scan of the page."""
    pattern = r'(?s)<a\s[^>]*href="(https?://[^"]+)"[^>]*>(.*?)</a>'
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("label"))
    rows = pages.select(key, F.posexplode(both).alias("idx", "a")).select(key, "idx", "a.href", T.collapsed(F.regexp_replace("a.label", r"<[^>]+>", "")).alias("label"))
    return rows.where(F.regexp_extract("href", r"^https?://([^/]+)", 1).isin(hosts))


def page_json(pages: DataFrame, key: str, html: str, script_id: str) -> DataFrame:
    """key, name, value: the entries of the normalised JSON graph that a page's script holds."""
    body = F.regexp_extract(html, rf'(?s)<script[^>]*id="{script_id}"[^>]*>(.*?)</script>', 1)
    return pages.select(key, F.explode(F.from_json(body, "map<string, string>")).alias("name", "value"))


def referenced(graph: DataFrame, key: str, start: str, list_field: str) -> DataFrame:
    """key, pos, name, value: the entries that a node's list of references names, in its order, by equi-joins."""
    refs = graph.where(F.col("name").startswith(start)).select(key, F.posexplode(F.from_json(F.get_json_object("value", f"$.{list_field}"), "array<struct<__ref: string>>")).alias("pos", "r"))
    return refs.select(key, "pos", F.col("r.__ref").alias("name")).join(graph, [key, "name"])


def excerpt(files: DataFrame, path: str, first: int, last: int) -> DataFrame:
    """file, excerpt: lines first..last (from 1) of a file without blank ones, put together; lines beyond the end count for nothing."""
    kept = F.filter(F.transform(F.slice(F.split("text", "\n"), first, last - first + 1), lambda x: F.trim(x)), lambda x: x != "")
    return files.where(F.col("file").endswith(path)).select("file", F.array_join(kept, " ").alias("excerpt"))


def with_default(default: DataFrame, override: DataFrame, key: str, value: str) -> DataFrame:
    """key, value, source: an override where there is one."""
    o = override.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    j = default.join(o, F.col(key) == F.col("_k"), "left")
    return j.select(key, F.coalesce("_v", value).alias(value), F.when(F.col("_v").isNotNull(), "override").otherwise("packaged").alias("source"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of its own file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)
