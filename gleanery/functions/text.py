"""Text and number formatting, on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes of the caption cleaner. Letters and numbers stand for "word characters"; the white
# space class lists every code point, since the JVM's own \s knows fewer.
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ALLOWED = rf"\p{{L}}\p{{N}}_{SPACE}.,:;!?()\-\[\]'\"«»„“/"
THINKING = r"(?is)<think\b[^>]*>.*?</think\s*>"


def strip_thinking(text: Column) -> Column:
    """Without the tagged thoughts of a model; an unclosed tag stays."""
    return F.regexp_replace(text, THINKING, "")


def whitelist_chars(text: Column) -> Column:
    return F.regexp_replace(text, f"[^{ALLOWED}]", "")


def collapse_space(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def clean_text(text: Column, thinking: bool = True, lowercase: bool = False) -> Column:
    """The caption cleaner: thoughts, then other characters, then white space, then case."""
    out = collapse_space(whitelist_chars(strip_thinking(text) if thinking else text))
    return F.lower(out) if lowercase else out


def rounded(x: Column, digits: int) -> Column:
    """x rounded by its exact binary value, half to even, as Python's round does."""
    return F.call_function("format_number", x, F.lit("0." + "0" * digits if digits else "0")).cast("double")


def percent(count: Column, total: Column) -> Column:
    """Share in percent with two digits; the division comes first."""
    return rounded(count.cast("double") / total * 100, 2)


def format_size(size: Column) -> Column:
    """Bytes as B, KB or MB with one digit, base 1024."""
    tenths = lambda x: F.call_function("format_number", x, F.lit("0.0"))
    return (
        F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < 1024**2, F.concat(tenths(size / 1024), F.lit(" KB")))
        .otherwise(F.concat(tenths(size / 1024**2), F.lit(" MB")))
    )


def rgb_hex(r: Column, g: Column, b: Column) -> Column:
    """#rrggbb in lower case."""
    return F.concat(F.lit("#"), *(F.lower(F.lpad(F.hex(x.cast("long")), 2, "0")) for x in (r, g, b)))


def shell_quote(text: Column) -> Column:
    """In single quotes for a shell."""
    return F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("'\\''")), F.lit("'"))


def file_uri(path: Column) -> Column:
    """file:// before an absolute path; a Windows path gets three slashes, all forward."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(path.rlike(r"^[A-Za-z]:"), F.concat(F.lit("file:///"), slashed)).otherwise(F.concat(F.lit("file://"), path))


def html_escape(text: Column) -> Column:
    """& < > and both quotes as references."""
    out = text
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(reference))
    return out


def suffix(name: Column) -> Column:
    """The suffix of a file name with its dot, as it is written; a name that only has a leading dot has none."""
    return F.regexp_extract(name, r"^\.*[^.].*?(\.[^.]*)$", 1)


def stem(name: Column) -> Column:
    return F.substr(name, F.lit(1), F.char_length(name) - F.char_length(suffix(name)))


def epoch_floor(seconds: Column) -> Column:
    """Whole seconds as text."""
    return seconds.cast("long").cast("string")


def serial_name(seconds: Column, serial: Column) -> Column:
    """Seconds, an underscore and the serial number in seven digits or more, as a .jpg name."""
    digits = serial.cast("string")
    return F.concat(epoch_floor(seconds), F.lit("_"), F.when(F.length(digits) < 7, F.lpad(digits, 7, "0")).otherwise(digits), F.lit(".jpg"))


def tokens_per_second(tokens: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, rounded(tokens / seconds, 2)).otherwise(F.lit(0.0))


def amortised_ms(elapsed_ms: Column, n_valid: Column) -> Column:
    """A batch's time for each of its valid items; null without any."""
    return F.when(n_valid > 0, elapsed_ms / n_valid)
