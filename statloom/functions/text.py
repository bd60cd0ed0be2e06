"""Column expressions over message texts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Intents in priority order with the fragments that reveal them.
INTENT_WORDS = {
    "model": [
        "predict",
        "model",
        "machine learning",
        "ml ",
        "classifier",
        "regression",
        "forecast",
        "accuracy",
        "feature importance",
        "train",
        "random forest",
    ],
    "clean": ["clean", "fix", "prepare", "missing", "duplicate", "impute", "tidy"],
    "visualize": ["visual", "chart", "graph", "plot", "histogram", "scatter", "heatmap"],
    "report": ["report", "summary document", "full report", "executive"],
    "analyze": [
        "analyz",
        "analyse",
        "statistic",
        "correlat",
        "distribut",
        "insight",
        "outlier",
        "hypothesis",
        "test",
        "describe",
    ],
}
DEFAULT_INTENT = "chat"
# Patterns of target phrases and of JSON inside prose.
TARGET_PHRASE = r"(?U)(?:predict|model|target|classify|forecast)\s+(?:the\s+)?([\w ]+)"
FENCED_BLOCK = r"(?i)```(?:json)?\s*\n?([\s\S]*?)\n?```"
OBJECT_BLOCK = r"(\{[\s\S]*\})"
ARRAY_BLOCK = r"(\[[\s\S]*\])"


def tag_intent(text: Column) -> Column:
    """First intent, in priority order, with one of its fragments in the message.

    The message is lowered once, as the item of an array, and then looked through for plain fragments,
    without patterns. A blank in a fragment also stands for an end of the message.
    """

    def tag(message: Column) -> Column:
        out = None
        for intent, words in INTENT_WORDS.items():
            hit = F.lit(False)
            for w in words:
                hit = hit | F.contains(message, F.lit(w))
            out = F.when(hit, intent) if out is None else out.when(hit, intent)
        return out.otherwise(DEFAULT_INTENT)

    lowered = F.array(F.concat(F.lower(text), F.lit(" ")))
    return F.when(text.isNotNull(), F.get(F.transform(lowered, tag), F.lit(0)))


# Number words that JSON itself doesn't have but is read with.
EXTRA_NUMBERS = r"(?<=[\[:,\s])-?(?:NaN|Infinity)(?=[\],}\s])"


def _valid_json(candidate: Column) -> Column:
    """The candidate if it is one JSON value and nothing else.

    The parser ignores what follows a value, so the candidate must also parse as an array's only item
    and as an object's only member: trailing text breaks the one, further items or members the other.
    """
    plain = F.regexp_replace(F.concat(F.lit(" "), candidate, F.lit(" ")), EXTRA_NUMBERS, "0")
    item = F.try_parse_json(F.concat(F.lit("["), plain, F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"x":'), plain, F.lit("}")))
    return F.when(item.isNotNull() & member.isNotNull(), candidate)


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def extract_json(text: Column) -> Column:
    """JSON inside a text: the whole text, a fenced block, an object, an array; else NULL.

    Repeated keys are accepted if ``spark.sql.variant.allowDuplicateKeys`` is set, as ``prepare`` does.
    """
    none = F.lit("")
    blocks = [_stripped(text), _stripped(F.regexp_extract(text, FENCED_BLOCK, 1))]
    blocks += [F.regexp_extract(text, p, 1) for p in (OBJECT_BLOCK, ARRAY_BLOCK)]
    return F.coalesce(*[F.when(b != none, _valid_json(b)) for b in blocks])


def extract_mention(text: Column, names: list[str]) -> Column:
    """The column a message talks about; earlier names win.

    A phrase after "predict", "model", ... decides first; otherwise any whole word does.
    """
    message = F.lower(text)
    phrase = F.trim(F.regexp_extract(message, TARGET_PHRASE, 1))
    in_phrase = [F.when((phrase != "") & F.contains(phrase, F.lit(n.lower())), F.lit(n)) for n in names]
    as_word = [F.when(F.regexp_like(message, F.lit(rf"(?U)\b{re.escape(n.lower())}\b")), F.lit(n)) for n in names]
    return F.coalesce(*in_phrase, *as_word)
