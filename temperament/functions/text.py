"""String columns: trimming, completeness, templates, answer and list parsing.

Everything here is a native column expression, so it stays inside whole-stage code generation and
works the same on batch and streaming frames.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python counts as whitespace; Java's and RE2's \s both know only some of them.
SPACE = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# the same, tested faster: only a character beyond the common ones is held against the rare ones
SPACES = (
    r"(?:[\x09-\x0d\x1c-\x20\x85\xa0]|(?![\x00-\x{167f}])[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])+"
)
# the same characters as a list, for trimming
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
FINISHED = r"\p{P}" + SPACE + r"*\z"
NUMBERED_LINE = r"(?s)\A(\p{Nd}+)\. (\p{L}.*[?.])\z"
# scripts that write words without blanks between them: every character is a token
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
# ASCII first: the classes of scripts are slow to test, and only other letters need them
TOKEN = (
    r"(?:[A-Za-z0-9_]++|[\p{L}\p{M}\p{N}&&[^" + UNSPACED + r"]])++|[^\p{L}\p{M}\p{N}_\x00-\x20]|[" + UNSPACED + "]"
)


def as_column(value) -> Column:
    """A plain string is a literal here, never a column name."""
    return value if isinstance(value, Column) else F.lit(value)


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """Whitespace-separated words; blank text has none."""
    return F.filter(F.split(text, SPACES), lambda word: word != "")


def is_finished(text: Column) -> Column:
    """True when the text, trailing blanks aside, ends in punctuation."""
    return text.rlike(FINISHED)


def token_count(text: Column) -> Column:
    """Default token counter: runs of word characters, and every other visible character.

    In scripts without blanks between words every character counts.
    """
    return F.regexp_count(text, F.lit(TOKEN))


def last_tokens(text: Column, limit: Column) -> Column:
    """The end of a text from its last ``limit`` tokens on; all of it when it has no more, nothing for a limit of 0."""
    tokens = F.regexp_extract_all(text, F.lit(r"[\x00-\x20]*(?:" + TOKEN + ")"), F.lit(0))

    def end(parts: Column) -> Column:
        tail = F.array_join(F.slice(parts, F.greatest(F.size(parts) - limit + 1, F.lit(1)), limit), "")
        tail = F.concat(F.regexp_replace(tail, r"\A[\x00-\x20]+", ""), F.regexp_extract(text, r"[\x00-\x20]*\z", 0))
        return F.when(F.size(parts) <= limit, text).otherwise(tail)

    # bound to a name, so that the text is taken apart once
    return F.when(limit <= 0, "").otherwise(F.get(F.transform(F.array(tokens), end), F.lit(0)))



def assistant_name(model, rename: dict[str, str] | None = None) -> Column:
    """First dash-separated part of a model's name, capitalised; ``rename`` maps exceptions."""
    stem = F.split_part(as_column(model), F.lit("-"), F.lit(1))
    name = F.concat(F.upper(F.substring(stem, 1, 1)), F.lower(F.substr(stem, F.lit(2))))
    for old, new in (rename or {}).items():
        name = F.when(name == old, F.lit(new)).otherwise(name)
    return name


def rename_assistant(text: Column, old, new) -> Column:
    """Replace every occurrence of one name by another (a lossy step, as names can be words)."""
    return F.replace(text, as_column(old), as_column(new))


def fill(template: str, **fields) -> Column:
    """Fill ``{placeholders}`` of a literal template from columns or plain strings.

    The template is cut into its literal stretches once, on the driver, so braces inside a value are
    never taken for another placeholder.
    """
    parts = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(as_column(fields[field]))
    return F.concat(*parts) if parts else F.lit("")


def answer(text: Column, *, lower: bool = False, allowed: list[str] | None = None) -> Column:
    """Text between the first ``<answer>`` and the first ``</answer>``, trimmed.

    Null when either tag is missing, empty when the closing tag comes first; with ``allowed``, any
    other value is null too.
    """
    opening = F.locate("<answer>", text)
    closing = F.locate("</answer>", text)
    start = opening + F.lit(len("<answer>"))
    inner = strip(F.substr(text, start, F.greatest(closing - start, F.lit(0))))
    if lower:
        inner = F.lower(inner)
    valid = (opening > 0) & (closing > 0)
    if allowed is not None:
        valid = valid & inner.isin(allowed)
    return F.when(valid, inner)


def without_reasoning(text: Column) -> Column:
    """What follows the first ``</think>`` up to the next one, trimmed; null without a tag."""
    return strip(F.get(F.split(strip(text), "</think>"), F.lit(1)))


def until(text: Column, marker: str) -> Column:
    return F.substring_index(text, marker, 1)


def numbered_messages(text: Column) -> Column:
    """Accepted messages of a numbered list, as ``array<struct<line:int, message:string>>``.

    A line counts when it is digits, a full stop, one space and a message that starts with a letter
    and ends in ``?`` or ``.``. ``line`` is the line's place in the text and keeps the order.
    """
    lines = F.transform(
        F.split(strip(text), "\n"),
        lambda line, place: F.struct(
            place.alias("line"), F.regexp_extract(line, NUMBERED_LINE, 2).alias("message")
        ),
    )
    return F.filter(lines, lambda item: item["message"] != "")


def string_list(text: Column) -> Column:
    """A JSON array of bare strings."""
    return F.from_json(text, "array<string>")
