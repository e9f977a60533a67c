"""Notes as text: rules, deviations, style dimensions, round summaries; and the names of their files.

Serialisers are column expressions, so a note is one value of a row; what is
put together from several rows (a chapter's deviations, a profile's dimensions)
is aggregated in a stated order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hibiki.functions import text as T

# The dimensions of a style profile, by number.
DIMENSIONS = [
    "Tone", "Voice", "Sentence structure", "Word choice", "Narrative distance", "Reader trust", "Internal monologue style", "Pacing", "Figurative language",
    "Dialogue integration", "Paragraph structure", "Repetition and motif", "Sensory emphasis", "Tense and temporal framing", "Connective tissue", "Character voice differentiation",
]
DEVIATION_ID = r"^part-(\d{3})-r\d+-d(?:ev)?\d+"
NO_PROFILE = "_(no style profile extracted yet)_"


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def canonical_dimension(number: Column, name: Column) -> Column:
    """The name that a number has, else the given one."""
    listed = F.array(*[F.lit(x) for x in DIMENSIONS])
    return F.coalesce(F.when(number >= 1, F.try_element_at(listed, number.cast("int"))), name)


def dimension_file(number: Column, name: Column) -> Column:
    return F.format_string("%02d-%s.md", number, slug(name))


def meta_line(name: str, value: Column) -> Column:
    """'name: value' and a line break; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\n")), F.lit(""))


def meta_list(name: str, values: Column) -> Column:
    """A list of the front matter; an empty one is []."""
    items = F.concat(F.lit(f"{name}:\n"), F.array_join(F.transform(values, lambda x: F.concat(F.lit("- "), x)), "\n"), F.lit("\n"))
    return F.when(F.size(values) > 0, items).otherwise(F.lit(f"{name}: []\n"))


def note(meta: list[Column], body: Column) -> Column:
    """Front matter and body; without front matter just the body."""
    return F.concat(F.lit("---\n"), *meta, F.lit("---\n\n"), body)


def rule_body(text: Column, extra: Column) -> Column:
    more = T.trimmed(F.coalesce(extra, F.lit("")))
    return F.concat(F.lit("# Rule\n\n"), T.trimmed(text), F.lit("\n"), F.when(more != "", F.concat(F.lit("\n"), more, F.lit("\n"))).otherwise(""))


def rule_note() -> Column:
    """The note of a row with id, state, pov_scope, scene_scope, priority, supporting (arrays), created_round,
    last_validated_round, score_delta, prune_reason, text, extra; nulls among the last leave no line."""
    c = F.col
    meta = [meta_line("id", c("id")), meta_line("state", c("state")), meta_list("pov_scope", c("pov_scope")), meta_list("scene_scope", c("scene_scope")), meta_line("priority", c("priority")), meta_list("supporting_deviations", c("supporting"))]
    meta += [meta_line(k, c(k)) for k in ("created_round", "last_validated_round", "score_delta", "prune_reason")]
    return note(meta, rule_body(c("text"), c("extra")))


def rule_line() -> Column:
    """One line of a prompt for a rule with id, text, pov_scope, scene_scope, priority, prune_reason."""
    c = F.col
    scope = lambda x: F.concat(F.lit("["), F.array_join(F.transform(c(x), lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "), F.lit("]"))
    pruned = F.when(F.coalesce(c("prune_reason"), F.lit("")) != "", F.concat(F.lit(", prune_reason="), c("prune_reason"))).otherwise("")
    return F.concat(F.lit("- ["), c("id"), F.lit("] "), c("text"), F.lit(" (pov_scope="), scope("pov_scope"), F.lit(", scene_scope="), scope("scene_scope"), F.lit(", priority="), c("priority").cast("string"), pruned, F.lit(")"))


def rule_lines(rules: DataFrame) -> DataFrame:
    """prompt: all rules by falling priority, then id; '_(none)_' without any."""
    rows = rules.withColumn("_line", rule_line())
    return rows.agg(F.coalesce(F.expr("listagg(_line, '\n') WITHIN GROUP (ORDER BY priority DESC, id)"), F.lit("_(none)_")).alias("prompt"))


def chapter_of(supporting: Column) -> Column:
    """The chapter of the first id in the list that has the form of a deviation's, else 000."""
    ids = F.transform(supporting, lambda x: F.regexp_extract(T.trimmed(x), DEVIATION_ID, 1))
    return F.coalesce(F.try_element_at(F.filter(ids, lambda x: x != ""), F.lit(1)), F.lit("000"))


def deviation_id(part_id: Column, round_: Column, idx: Column) -> Column:
    return F.format_string("part-%s-r%02d-d%02d", F.regexp_replace(part_id, "^part_", ""), round_, idx)


def deviation_file(part_id: Column, round_: Column) -> Column:
    return F.concat(F.format_string("round-%02d/", round_), F.replace(part_id, F.lit("_"), F.lit("-")), F.lit("-deviations.md"))


def deviation_text() -> Column:
    """The section of a deviation with id, category, severity, pov_specific, jp_source, llm_rendering, reference_rendering, violates_rule_id, notes."""
    c = F.col
    part = lambda name, x: F.concat(F.lit(f"- **{name}:** "), x, F.lit("\n"))
    given = lambda x: F.coalesce(x, F.lit("")) != ""
    return F.concat(
        F.lit("## "), c("id"), F.lit("\n\n"), F.lit("- **ID:** `"), c("id"), F.lit("`\n"), part("Category", c("category")), part("Severity", c("severity")), part("POV-specific", c("pov_specific").cast("string")),
        part("JP source", c("jp_source")), part("LLM rendering", c("llm_rendering")), part("Reference rendering", c("reference_rendering")),
        F.when(given(c("violates_rule_id")), part("Violates rule", F.concat(F.lit("[["), c("violates_rule_id"), F.lit("]]")))).otherwise(""), F.when(given(c("notes")), part("Notes", c("notes"))).otherwise(""),
    )


def deviation_notes(parts: DataFrame, deviations: DataFrame) -> DataFrame:
    """part_id, round, path, note: the note of every part and round, one without deviations too.

    parts: part_id, round, pov. deviations: part_id, round, idx and the columns of deviation_text() but id.
    """
    rows = deviations.withColumn("id", deviation_id(F.col("part_id"), F.col("round"), F.col("idx"))).withColumn("_text", deviation_text())
    per = rows.groupBy("part_id", "round").agg(F.count("*").alias("n"), F.expr("listagg(_text, '\n') WITHIN GROUP (ORDER BY idx)").alias("_body"))
    head = F.concat(F.lit("# Deviations: "), F.col("part_id"), F.format_string(", Round %02d\n\n", F.col("round")))
    meta = [meta_line("part_id", F.col("part_id")), meta_line("round", F.col("round")), meta_line("pov", F.col("pov")), meta_line("deviation_count", F.coalesce("n", F.lit(0)))]
    out = parts.join(per, ["part_id", "round"], "left")
    return out.select("part_id", "round", deviation_file(F.col("part_id"), F.col("round")).alias("path"), note(meta, F.concat(head, F.coalesce("_body", F.lit("_No deviations flagged._")))).alias("note"))


def profile_prompt(dimensions: DataFrame) -> DataFrame:
    """prompt: the bodies of all dimensions by number, or a placeholder where none has any text.

    dimensions: number, body, extracted_at.
    """
    body = dimensions.withColumn("_body", T.trimmed(F.coalesce("body", F.lit(""))))
    whole = T.trimmed(F.expr("listagg(_body, '\n\n') WITHIN GROUP (ORDER BY number)"))
    some = F.coalesce(F.bool_or(F.col("_body") != ""), F.lit(False)) & F.coalesce(F.bool_or(F.coalesce("extracted_at", F.lit("")) != ""), F.lit(False))
    return body.agg(F.when(some, whole).otherwise(NO_PROFILE).alias("prompt"), F.count("*").alias("n_dimensions"), some.alias("has_content"))


def shared_provenance(dimensions: DataFrame) -> DataFrame:
    """extracted_through, n_chapters, extracted_at, model of the first dimension that has any."""
    names = ["extracted_through", "n_chapters", "extracted_at", "model"]
    return dimensions.where(F.coalesce("extracted_at", F.lit("")) != "").agg(F.min_by(F.struct(*names), "number").alias("p")).select("p.*")


def output_path(part_id: Column, suffix: Column) -> Column:
    """Where a part's output stands: its folder, with the suffix if there is one."""
    return F.concat(part_id, F.when(F.coalesce(suffix, F.lit("")) != "", F.concat(F.lit("-"), suffix)).otherwise(""), F.lit("/translation.en.txt"))


def label_suffix(label: Column) -> Column:
    return F.concat(F.lit("bench-"), label)


def missing_placeholders(text: Column, required: list[str]) -> Column:
    """The placeholders that a template lacks."""
    return F.filter(F.array(*[F.lit(x) for x in required]), lambda x: ~F.contains(F.coalesce(text, F.lit("")), x))


def rekeyed(old: DataFrame, new: DataFrame, key: str, prefix: str) -> DataFrame:
    """old and all of new; a new row whose key is taken gets the next free number behind `prefix`, in the order of its key."""
    from pyspark.sql import Window

    number = F.regexp_extract(key, f"^{prefix}(\\d+)$", 1).try_cast("long")
    top = old.select(number.alias("n")).unionByName(new.select(number.alias("n"))).agg(F.coalesce(F.max("n"), F.lit(0)).alias("_top"))
    taken = new.join(old.select(key), key, "left_semi")
    placed = taken.join(F.broadcast(top), F.lit(True)).withColumn("_n", F.col("_top") + F.row_number().over(Window.orderBy(key)))  # one row; collisions only
    moved = placed.withColumn(key, F.concat(F.lit(prefix), F.col("_n").cast("string"))).select(*new.columns)
    return old.unionByName(new.join(old.select(key), key, "left_anti").select(*old.columns)).unionByName(moved.select(*old.columns))
