"""Column functions over strings: keys, prompts, path fields, JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def dataset_key(c: Column) -> Column:
    """The first segment of group/name/version."""
    return F.substring_index(c, "/", 1)


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(""))


def safe_name(c: Column) -> Column:
    """Runs of characters that don't belong in a file name become one underscore."""
    return F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "_")


def sample_id(*parts: Column | str) -> Column:
    return F.concat_ws("|", *parts)


#: The wording that a trained model expects around an instruction.
OPENING, CLOSING = "<s> You are a helpful assistant. USER: ", " ASSISTANT:"
QUESTION = "What action should the robot take to `"


def stripped(c: Column) -> Column:
    """Without white space at both ends, of any script."""
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def chat(message: Column) -> Column:
    return F.concat(F.lit(OPENING), message, F.lit(CLOSING))


def prompt(instruction: Column) -> Column:
    return chat(F.concat(F.lit(QUESTION), stripped(instruction), F.lit("`")))


def without_image_tag(c: Column) -> Column:
    return F.replace(c, F.lit("<image>\n"), F.lit(""))


def file_ordinal(name: Column) -> Column:
    """The digits before the first underscore of a file name; null if there are none."""
    return F.nullif(F.regexp_extract(name, "^(\\d+)_", 1), F.lit("")).cast("long")


def outcome(stem: Column, words: tuple[str, str] = ("success", "failure")) -> Column:
    """1, 0 or null by which word a file's stem has; the first counts where it has both."""
    return F.when(F.contains(stem, F.lit(words[0])), 1).when(F.contains(stem, F.lit(words[1])), 0)


def field_specs(spec: Column) -> Column:
    """Parses "[a],b+c": array of (names, loss); a field in brackets bears no loss."""
    def one(f: Column) -> Column:
        quiet = f.startswith("[") & f.endswith("]")
        bare = F.when(quiet, F.substring(f, F.lit(2), F.length(f) - 2)).otherwise(f)
        return F.struct(F.split(bare, "\\+").alias("names"), F.when(quiet, 0.0).otherwise(1.0).alias("loss"))

    return F.transform(F.split(spec, ","), one)


def coerce(text: str) -> int | float | bool | str:
    """A command-line value as the narrowest of int, float, bool and str; literals only, nothing is evaluated."""
    if re.fullmatch(r"[+-]?\d+", text):
        return int(text)
    try:
        return float(text)
    except ValueError:
        return {"true": True, "false": False}.get(text.lower(), text)


def coerced_kind(c: Column) -> Column:
    """Which type `coerce` gives: int, float, bool or str."""
    return (
        F.when(c.rlike(r"^[+-]?\d+$"), "int")
        .when(F.try_to_number(c, F.lit("S999999999999D999999999")).isNotNull() | c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), "float")
        .when(F.lower(c).isin("true", "false"), "bool")
        .otherwise("str")
    )


def lossy(raw: Column) -> Column:
    """Bytes as UTF-8 text, what isn't valid as the replacement character."""
    return F.make_valid_utf8(raw.cast("string"))
