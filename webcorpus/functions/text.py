"""Text functions: trimming, truncation, the language-block line filter, tokens
and windows. All are Column expressions over one row; none shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space, and line boundaries.
WHITESPACE = (
    "\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The Unicode class has all of these but the separators 1c to 1f.
NON_SPACE = r"(?U)[^\s\u001c-\u001f]"
LINE_BREAK = r"\R|[\u001c-\u001e]"

# What opens and what closes a language-selector block.
BLOCK_OPENER = "select language"
BLOCK_CLOSER = "powered by translate"
LONG_LINE = 40
LONG_WORD = 6
LONG_WORDS = 4
SHORT_RESULT = 200

# A word with the blanks after it, or blanks that open the text,
# so that the tokens of a text joined together give the text back.
TOKEN = "^[ \\t\\n\\f\\r]+|[^ \\t\\n\\f\\r]+[ \\t\\n\\f\\r]*"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """Bind a value that `then` uses several times.

    A column expression is a tree: without the binding every use would repeat,
    and may evaluate, the whole expression below it.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def strip(text: Column | str) -> Column:
    """Cut white space, Unicode included, from both ends."""
    return F.btrim(_col(text), F.lit(WHITESPACE))


def non_blank(text: Column | str) -> Column:
    """True when some character is not white space; false for null."""
    return F.coalesce(_col(text).rlike(NON_SPACE), F.lit(False))


def truncate_text(text: Column | str, limit: int) -> Column:
    """At most `limit` characters, cut back to the last full stop, line end or blank.

    Without such a character after the first position the cut is hard.
    """
    text = _col(text)
    head = F.left(text, F.lit(limit))
    cut = F.regexp_extract(head, r"(?s)^(.+[. \n])", 1)
    return F.when(
        F.length(text) > limit, F.when(cut != "", strip(cut)).otherwise(head)
    ).otherwise(text)


def lines_of(text: Column | str) -> Column:
    """Lines of a text; a line break at the very end opens no further line."""
    return let(
        F.split(_col(text), LINE_BREAK),
        lambda lines: F.when(
            F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)
        ).otherwise(lines),
    )


def opens_block(line: Column) -> Column:
    """A language-selector line, or a long line with many long words."""
    wordy = (F.length(line) > LONG_LINE) & (
        F.regexp_count(line, F.lit(f"{NON_SPACE}{{{LONG_WORD},}}")) > LONG_WORDS
    )
    return line.rlike(f"(?i){BLOCK_OPENER}") | wordy


def closes_block(line: Column) -> Column:
    return line.rlike(f"(?i){BLOCK_CLOSER}") | ~non_blank(line)


def mark_lines(text: Column | str) -> Column:
    """The text with a mark before each line: O opens a block, C closes one, - neither."""
    marked = F.transform(
        lines_of(text),
        lambda line: F.concat(
            F.when(opens_block(line), "O").when(closes_block(line), "C").otherwise("-"),
            line,
        ),
    )
    return F.array_join(marked, "\n")


def last_mark(marked: Column) -> Column:
    """1 if the last line that opens or closes a block opens it, -1 if it closes it, else null."""
    mark = F.regexp_extract(marked, r"(?s).*(?<![^\n])([OC])", 1)
    return F.when(mark == "O", 1).when(mark == "C", -1)


def unblocked_lines(marked: Column, inside: Column | None = None) -> Column:
    """Lines of a marked text without every block from an opener up to its closing line.

    A block is one pattern, so this is one linear pass, however many lines the
    text has. With `inside` the text begins inside a block.
    """
    if inside is not None:
        marked = F.concat(F.when(inside, "O\n").otherwise(""), marked)
    rest = F.regexp_replace(marked, r"(?s)(?<![^\n])O.*?(?:\nC[^\n]*|\z)", "")
    kept = F.filter(F.split(rest, "\n"), lambda line: line != "")
    return F.transform(kept, lambda line: F.substring(line, 2, 2**31 - 1))


def drop_language_blocks(text: Column | str) -> Column:
    """Remove every block from an opening line up to its closing line."""
    return F.array_join(unblocked_lines(mark_lines(text)), "\n")


def prefer_filtered(filtered: Column, text: Column) -> Column:
    """The filtered text, unless too little is left of it."""
    return let(
        strip(filtered),
        lambda cleaned: F.when(F.length(cleaned) > SHORT_RESULT, cleaned).otherwise(text),
    )


def clean_lines(text: Column | str) -> Column:
    return let(_col(text), lambda t: prefer_filtered(drop_language_blocks(t), t))


def tokenize(text: Column | str) -> Column:
    """Words with the white space after them; joined they give the text back."""
    return F.regexp_extract_all(_col(text), F.lit(TOKEN), F.lit(0))


def token_count(text: Column | str) -> Column:
    return F.regexp_count(_col(text), F.lit(TOKEN))


def window_count(tokens: Column, size: int, overlap: int) -> Column:
    """How many windows this many tokens give: one per started step."""
    return F.ceil(tokens / F.lit(_step(size, overlap))).cast("int")


def token_windows(tokens: Column, size: int, overlap: int) -> Column:
    """Array of window texts: `size` tokens every size-overlap; empty for no tokens."""
    step = _step(size, overlap)

    def cut(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1)), F.lit(step))
        windows = F.transform(
            starts, lambda at: F.array_join(F.slice(found, at, F.lit(size)), "")
        )
        return F.when(F.size(found) > 0, windows).otherwise(
            F.array().cast("array<string>")
        )

    return let(tokens, cut)


def _step(size: int, overlap: int) -> int:
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError(f"need 0 <= overlap < size, got size={size} overlap={overlap}")
    return size - overlap


def header(headers: Column | str, name: str) -> Column:
    """Value of a header whatever the case of its name; null when absent."""
    hits = F.filter(
        F.map_entries(_col(headers)), lambda e: F.lower(e["key"]) == name.lower()
    )
    return F.get(hits, F.lit(0))["value"]


def last_modified(headers: Column | str, fetched_at: Column | str) -> Column:
    """The Last-Modified header as it stands, else the time of the fetch in UTC."""
    utc = F.to_utc_timestamp(_col(fetched_at), F.current_timezone())
    fallback = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.coalesce(header(headers, "Last-Modified"), fallback)
