"""From JSON lines to ``(id, text)`` records, with a reason for every rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.json import (
    STRICT,
    described,
    filled_text,
    object_in,
    reject_reason,
    truthy,
    unexpected,
    wrapped,
)
from shelfmark.functions.text import label_with_definition
from shelfmark.operators.once import evaluate_once

# Field names of the two record kinds.
PAPER_FIELDS = "paper_id variant, content struct<text:variant, title_en:variant>"
SUBJECT_FIELDS = "Code variant, `Classification Name` variant, Definition variant"

SKIP, FAILFAST = "skip", "failfast"


def with_object(df: DataFrame, fields: str, name: str, line: str = "line") -> DataFrame:
    """Add ``name``: the line's JSON object as ``struct<fields>``, parsed once; null
    when the line is not valid JSON or not an object."""
    items = evaluate_once(df, __items=wrapped(line, fields))
    return evaluate_once(items, **{name: object_in("__items", line)}).drop("__items")


def parse_papers(lines: DataFrame, line: str = "line") -> DataFrame:
    """Read paper lines into ``(…, paper_id, text, reason)``.

    ``text`` falls back from ``content.text`` to ``content.title_en``; empty
    counts as absent. ``reason`` is null for a usable line, even one whose id
    or text is missing; those are :func:`incomplete`.
    """
    parsed = with_object(lines, PAPER_FIELDS, "__rec", line)
    # A null struct is either a missing field (an empty object, by default) or
    # something that is not an object; only then is the line looked at again.
    bad_content = (
        f"__rec.content IS NULL AND from_json({line}, 'content variant', {STRICT}).content IS NOT NULL"
    )
    fields = evaluate_once(
        parsed,
        __id=described("__rec.paper_id"),
        __text=described("__rec.content.text"),
        __title=described("__rec.content.title_en"),
        __reason=F.coalesce(
            reject_reason(line, "__rec"), F.expr(f"CASE WHEN {bad_content} THEN 'bad_content' END")
        ),
    )
    use_title = f"NOT {truthy('__text')}"
    bad_field = f"{unexpected('__id')} OR {unexpected('__text')} OR ({use_title} AND {unexpected('__title')})"
    return evaluate_once(
        fields,
        paper_id=F.expr(filled_text("__id")),
        text=F.expr(f"if({use_title}, {filled_text('__title')}, {filled_text('__text')})"),
        reason=F.expr(f"coalesce(__reason, CASE WHEN {bad_field} THEN 'bad_field' END)"),
    ).select(*lines.columns, "paper_id", "text", "reason")


def parse_subjects(lines: DataFrame, line: str = "line") -> DataFrame:
    """Read subject lines into ``(…, code, label, definition, reason)``.

    Missing, null and empty labels and definitions become ``""``.
    """
    parsed = with_object(lines, SUBJECT_FIELDS, "__rec", line)
    fields = evaluate_once(
        parsed,
        __code=described("__rec.Code"),
        __label=described("__rec.`Classification Name`"),
        __definition=described("__rec.Definition"),
        __reason=reject_reason(line, "__rec"),
    )
    bad_field = " OR ".join(unexpected(f) for f in ("__code", "__label", "__definition"))
    return evaluate_once(
        fields,
        code=F.expr(filled_text("__code")),
        label=F.expr(f"coalesce({filled_text('__label')}, '')"),
        definition=F.expr(f"coalesce({filled_text('__definition')}, '')"),
        reason=F.expr(f"coalesce(__reason, CASE WHEN {bad_field} THEN 'bad_field' END)"),
    ).select(*lines.columns, "code", "label", "definition", "reason")


def usable(parsed: DataFrame, mode: str = SKIP) -> DataFrame:
    """Drop rejected lines, or fail on the first one when ``mode`` is ``failfast``."""
    good = F.col("reason").isNull()
    if mode == FAILFAST:
        good = F.when(good, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("rejected line: "), F.col("reason"))).cast("boolean")
        )
    elif mode != SKIP:
        raise ValueError(f"unknown mode {mode!r}")
    return parsed.where(good)


def rejected(parsed: DataFrame) -> DataFrame:
    """The quarantine: rejected lines with their reason."""
    return parsed.where(F.col("reason").isNotNull())


def _complete(parsed: DataFrame) -> Column:
    if "code" in parsed.columns:
        return F.col("code").isNotNull() & (F.col("label") != "")
    return F.col("paper_id").isNotNull() & F.col("text").isNotNull()


def incomplete(parsed: DataFrame) -> DataFrame:
    """Usable lines that lack a required field and are therefore not embedded."""
    return parsed.where(F.col("reason").isNull() & ~_complete(parsed))


def paper_texts(parsed: DataFrame, mode: str = SKIP) -> DataFrame:
    """``(…, id, text)`` of papers with both an id and a text; blank text counts as text."""
    kept = usable(parsed, mode).where(_complete(parsed))
    return kept.withColumn("id", F.col("paper_id")).drop("paper_id", "reason", "line")


def subject_texts(parsed: DataFrame, mode: str = FAILFAST) -> DataFrame:
    """``(…, id, text)`` of subjects with a code and a label, as ``"label. definition"``."""
    kept = usable(parsed, mode).where(_complete(parsed))
    return kept.withColumns(
        {"id": F.col("code"), "text": label_with_definition(F.col("label"), F.col("definition"))}
    ).drop("code", "label", "definition", "reason", "line")
