"""Pieces of DuckDB SQL used by many checks."""

from __future__ import annotations

from string import Formatter

# patterns of the checks' own, in the syntax of DuckDB's engine
SPACE = r"[\t\n\x{0b}\f\r\x{1c}\x{1d}\x{1e}\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
PIECE = r"(?:[_\p{N}\p{M}\p{L}]+|[^_\p{N}\p{M}\p{L}\x{00}-\x{20}])"

NL = "chr(10)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '\\A{SPACE}+|{SPACE}+\\z', '', 'g')"


def rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{SPACE}+\\z', '')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{SPACE}+'), lambda w: w <> '')"


def finished(x: str) -> str:
    return f"regexp_matches({x}, '\\p{{P}}{SPACE}*\\z')"


def tokens(x: str) -> str:
    return f"len(regexp_extract_all({apart(x)}, '{PIECE}'))"


def apart(x: str) -> str:
    """Characters of scripts without blanks set apart by a control character."""
    return f"regexp_replace({x}, '({UNSPACED})', chr(1) || '\\1' || chr(1), 'g')"


def last_tokens(x: str, limit: str) -> str:
    pieces = f"regexp_extract_all({apart(x)}, '[\\x{{00}}-\\x{{20}}]*{PIECE}')"
    tail = f"replace(array_to_string(({pieces})[-({limit}):], ''), chr(1), '')"
    return (
        f"CASE WHEN {tokens(x)} <= {limit} THEN {x} ELSE regexp_replace({tail}, '\\A[\\x{{00}}-\\x{{20}}]+', '')"
        f" || regexp_extract({x}, '[\\x{{00}}-\\x{{20}}]*\\z') END"
    ).replace("\\\\", "\\")


def hash_key(seed, *columns: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(columns)}))"


def draw(seed, *columns: str) -> str:
    return f"('0x' || substr({hash_key(seed, *columns)}, 1, 8))::ubigint::bigint"


def options(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def pick(values: list[str], seed, *columns: str) -> str:
    return f"({options(values)})[({draw(seed, *columns)} % {len(values)}) + 1]"


def answer(x: str, lower: bool = False) -> str:
    start = f"(strpos({x}, '<answer>') + 8)"
    inner = strip(f"substr({x}, {start}, greatest(strpos({x}, '</answer>') - {start}, 0))")
    inner = f"lower({inner})" if lower else inner
    return (
        f"CASE WHEN strpos({x}, '<answer>') > 0 AND strpos({x}, '</answer>') > 0 THEN {inner} END"
    )


def verdict(x: str) -> str:
    return f"CASE WHEN {answer(x)} IN ('1', '2') THEN {answer(x)} END"


def fill(template: str, **fields: str) -> str:
    parts = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(text(literal))
        if field is not None:
            parts.append(f"({fields[field]})")
    return "(" + " || ".join(parts) + ")"


def turn(role: str, x: str) -> str:
    return f"'<|im_start|>{role}' || {NL} || ({x}) || '<|im_end|>' || {NL}"


def render(*turns: tuple[str, str]) -> str:
    body = " || ".join(turn(role, x) for role, x in turns)
    return f"({body} || '<|im_start|>assistant' || {NL})"


def numbered_line(x: str) -> str:
    return f"regexp_extract({x}, '(?s)^[\\p{{Nd}}]+[.] ([\\p{{L}}].*[.?])$', 1)"
