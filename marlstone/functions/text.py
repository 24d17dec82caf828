"""Text functions, all JVM-side."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's strings have it: Unicode's, and four more controls (as ranges: a class of properties is slow).
_SPACES = r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_SPACE = f"[{_SPACES}]"
#: The same characters one by one (a pattern that ends at the text's end tries every inner run of white space to its end).
_EACH_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def stripped(text: Column) -> Column:
    """Without white space of any kind at the ends, in linear time; null stays null."""
    return F.trim(text, F.lit(_EACH_SPACE))


def is_blank(text: Column) -> Column:
    """Null, or nothing but white space."""
    return stripped(F.coalesce(text, F.lit(""))) == ""


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _collapsed(text: Column) -> Column:
    """Runs of white space as one space. (A pattern of all kinds of white space takes four times as long.)"""
    plain = F.translate(F.coalesce(text, F.lit("")), _EACH_SPACE, " " * len(_EACH_SPACE))
    return F.trim(F.regexp_replace(plain, "  +", " "))


@cache
def _foldings() -> dict[str, str]:
    """Lower-case characters whose case folding is something else (the sharp s, final sigma, ligatures ...)."""
    every = map(chr, range(sys.maxunicode + 1))
    return {c: c.casefold() for c in every if c.casefold() != c == c.lower()}


@cache
def _folding_class() -> str:
    """An expression for any character that lower case alone doesn't fold (the capital sigma: at a word's end)."""
    return _class({i for i, c in enumerate(map(chr, range(sys.maxunicode + 1))) if c.casefold() != c.lower()} | {ord("Σ")})


@cache
def _folding_edges() -> str:
    """Where a lower-case character that folds further begins or ends."""
    own = _class(set(map(ord, _foldings())))
    return f"(?<={own})|(?={own})"


def _class(codes: set[int]) -> str:
    """Characters that aren't ASCII, by ranges; what is ASCII is passed over at once."""
    starts, ends = sorted(c for c in codes if c - 1 not in codes), sorted(c for c in codes if c + 1 not in codes)
    return "[[^\\x00-\\x7F]&&[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(starts, ends)) + "]]"


def casefold(text: Column) -> Column:
    """Full Unicode case folding: lower case, and the few characters that fold further."""
    table = F.create_map(*[F.lit(x) for kv in _foldings().items() for x in kv])
    fold = lambda part: F.when(F.char_length(part) == 1, F.coalesce(F.try_element_at(table, part), part)).otherwise(part)  # noqa: E731  only single characters are looked up
    further = lambda low: F.array_join(F.transform(F.split(low, _folding_edges()), fold), "")
    return _once(text, lambda t: F.when(t.rlike(_folding_class()), further(F.lower(t))).otherwise(F.lower(t)))


def normalize_answer(text: Column) -> Column:
    """Null as '', white space collapsed, case folded."""
    return casefold(_collapsed(text))


def normalize_training_answer(text: Column) -> Column:
    """The training-time normaliser: lower case only, the sharp s stays."""
    return F.lower(_collapsed(text))


def exact_match(answer: Column, expected: Column) -> Column:
    """Normalised equality with an expected answer that isn't empty."""
    return _once(normalize_answer(expected), lambda want: (want != "") & (normalize_answer(answer) == want))


def contains_expected(answer: Column, expected: Column) -> Column:
    return _once(normalize_answer(expected), lambda want: (want != "") & F.contains(normalize_answer(answer), want))


def token_estimate(text: Column) -> Column:
    """Runs of word characters, and each other visible character, by the classes of Python's re."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_SPACES}]")).cast("long")


def characters(text: Column) -> Column:
    return F.char_length(F.coalesce(text, F.lit(""))).cast("long")


def char_budget_tokens(chars: Column, overhead: int = 512) -> Column:
    """A third of the characters, one at least, and the fixed overhead."""
    return F.greatest(F.lit(1), F.floor(chars / 3)).cast("long") + overhead


def strip_terminal_control(text: Column) -> Column:
    """Without ANSI and OSC sequences and without backspaces."""
    return F.regexp_replace(text, "\x1b\\][^\x07\x1b]*(?:\x07|\x1b\\\\)|\x1b\\[[0-?]*[ -/]*[@-~]|\x1b[@-Z\\\\-_]|\b", "")


def strip_checksum(text: Column) -> Column:
    return F.regexp_replace(text, "^sha256:", "")


def label(name: Column) -> Column:
    """A display label: underscores become spaces, the first letter a capital, all others small."""
    spaced = stripped(F.replace(name, F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.lower(F.substring(spaced, F.lit(2), F.length(spaced))))


def format_metric(value: Column, digits: int = 4, unit: str = "") -> Column:
    """Fractions with a fixed number of digits, anything else as it is, and a unit; 'unavailable' for null."""
    fraction = F.typeof(value).isin("double", "float") | F.startswith(F.typeof(value), F.lit("decimal"))
    shown = F.when(fraction, F.format_string(f"%.{digits}f", value.cast("double"))).otherwise(value.cast("string"))
    return F.when(value.isNull(), "unavailable").otherwise(F.concat(shown, F.lit(unit)))


def loading_status(seconds: Column, vram_bytes: Column, percent: Column, watts: Column, celsius: Column) -> Column:
    """One line: elapsed, memory, utilisation, power, temperature; unknown parts are left out."""
    gib = vram_bytes / (1 << 30)
    return F.concat_ws(
        " | ",
        F.format_string("%.0fs", seconds.cast("double")),
        F.when(gib.isNotNull(), F.format_string("VRAM %.1fG", gib.cast("double"))),
        F.when(percent.isNotNull(), F.format_string("GPU %.0f%%", percent.cast("double"))),
        F.when(watts.isNotNull(), F.format_string("%.0fW", watts.cast("double"))),
        F.when(celsius.isNotNull(), F.format_string("%.0fC", celsius.cast("double"))),
    )


def progress_line(step: Column, steps: Column, loss: Column, cpu: Column, ram_bytes: Column, gpu_percent: Column, gpu_bytes: Column, watts: Column) -> Column:
    """One line of a run's progress; unknown device readings are left out, 'GPU n/a' without any."""
    gib = lambda b: F.format_string("%.2f GiB", b / (1 << 30))
    device = F.concat_ws(" ", F.when(gpu_percent.isNotNull(), F.format_string("%.0f%%", gpu_percent.cast("double"))), F.when(gpu_bytes.isNotNull(), gib(gpu_bytes)), F.when(watts.isNotNull(), F.format_string("%.0fW", watts.cast("double"))))
    return F.concat_ws(
        " | ",
        F.format_string("step %d/%d", step.cast("long"), steps.cast("long")),
        F.format_string("loss %.4f", loss.cast("double")),
        F.when(cpu.isNotNull(), F.format_string("CPU %.0f%%", cpu.cast("double"))),
        F.when(ram_bytes.isNotNull(), F.concat(F.lit("RAM "), gib(ram_bytes))),
        F.concat(F.lit("GPU "), F.when(device == "", "n/a").otherwise(device)),
    )


def without_fences(text: Column) -> Column:
    """The content of a fenced block, without the fence and its json tag."""
    bare = stripped(text)
    fence = F.lit("```")
    inner = stripped(F.substring(bare, F.lit(4), F.length(bare) - 6))
    inner = F.when(F.startswith(inner, F.lit("json")), stripped(F.substring(inner, F.lit(5), F.length(inner)))).otherwise(inner)
    return F.when(F.startswith(bare, fence) & F.endswith(bare, fence) & (F.length(bare) >= 6), inner).otherwise(bare)


def evidence_text(*fields: Column) -> Column:
    """The first string of the candidates, else ''."""
    return F.coalesce(*fields, F.lit(""))


def metric_segment(name: Column) -> Column:
    """A metric name part: other characters become one underscore, 120 at most, 'unnamed' if empty."""
    clean = F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9_.-]+", "_"), r"^[_.]+|[_.]+$", "")
    cut = F.substring(clean, 1, 120)
    return F.when(cut == "", "unnamed").otherwise(cut)


#: What a secret's name contains, and what stands for its value (in a query: percent-encoded).
_SECRET = "secret|password|token|api_key"
REDACTED, REDACTED_IN_QUERY = "<redacted>", "%3Credacted%3E"


def redacted(key: Column, value: Column) -> Column:
    """The value, hidden where its key names a secret; null stays null. URIs are hidden in part."""
    shown = F.when(F.contains(value, F.lit("://")), redacted_uri(value)).otherwise(value)
    return F.when(F.lower(key).rlike(_SECRET) & value.isNotNull(), REDACTED).otherwise(shown)


def redacted_uri(uri: Column) -> Column:
    """A URI without user information and with secret query values hidden."""
    bare = F.regexp_replace(uri, r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/@?#]*@", "$1")
    return F.regexp_replace(bare, rf"(?i)([?&][^=&#]*(?:{_SECRET})[^=&#]*=)[^&#]*", f"$1{REDACTED_IN_QUERY}")
