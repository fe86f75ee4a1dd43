"""Text, path and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_DOCUMENT_CHARS = 50
MIN_TEXT_LAYER_CHARS = 100

# ISO 639-2/B languages with Cyrillic and Greek scripts, the rest being Latin.
CYRILLIC = ("bul", "rus", "ukr", "srp", "mkd", "bel")
GREEK = ("gre", "ell")
# ISO 639-2/B to two-letter codes of the languages that catalogue queries use.
TWO_LETTERS = {
    "bul": "bg", "hrv": "hr", "cze": "cs", "dan": "da", "dut": "nl", "eng": "en", "est": "et", "fin": "fi", "fre": "fr", "ger": "de", "gre": "el", "hun": "hu", "gle": "ga", "ita": "it",
    "lav": "lv", "lit": "lt", "mlt": "mt", "pol": "pl", "por": "pt", "rum": "ro", "slo": "sk", "slv": "sl", "spa": "es", "swe": "sv",
}


def strip(c: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_len(c: Column) -> Column:
    return F.length(strip(c))


def word_count(c: Column) -> Column:
    """Words between Unicode white space, counted where they stand."""
    return F.regexp_count(c, F.lit(r"(?U)\S+")).cast("long")


def keeps_document(c: Column) -> Column:
    """A document with a text long enough to be kept."""
    return strip_len(c) >= MIN_DOCUMENT_CHARS


def extraction_tier(c: Column) -> Column:
    """text_layer, ocr or dropped, by the length of what was extracted."""
    n = strip_len(c)
    return F.when(n >= MIN_TEXT_LAYER_CHARS, "text_layer").when(n >= MIN_DOCUMENT_CHARS, "ocr").otherwise("dropped")


def truncated(c: Column, limit: int, notice: str) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(notice))).otherwise(c)


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def stem(c: Column) -> Column:
    """Base name without its last suffix; names that begin with the only dot keep it."""
    return F.regexp_replace(basename(c), r"(?<=.)\.[^.]+$", "")


def parent_prefix(c: Column) -> Column:
    """Folders as a flat prefix: a/b/x.mp4 to a__b__; none for a bare name."""
    folder = F.regexp_extract(c, r"^(.*)/[^/]*$", 1)
    return F.when(folder == "", F.lit("")).otherwise(F.concat(F.replace(folder, F.lit("/"), F.lit("__")), F.lit("__")))


def normal_separators(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def _mapped(c: Column, values: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def two_letters(c: Column) -> Column:
    """ISO 639-2/B language to two letters, null if unknown."""
    return _mapped(c, TWO_LETTERS)


def iso_639(c: Column) -> Column:
    """Two-letter language to ISO 639-2/B, null if unknown."""
    return _mapped(c, {two: three for three, two in TWO_LETTERS.items()})


def script_of(codes: Column) -> Column:
    """Script of a list of languages: that of the first one that is not Latin, whatever its case."""
    first = F.element_at(F.filter(F.transform(codes, F.lower), lambda c: c.isin(*CYRILLIC, *GREEK)), 1)
    named = F.when(F.size(F.filter(F.transform(codes, F.lower), lambda c: c.isin(*CYRILLIC, *GREEK))) > 0, first)
    return F.when(named.isin(*CYRILLIC), "cyrillic").when(named.isin(*GREEK), "greek").otherwise("latin")


def resolved(template: Column, values: dict[str, str]) -> Column:
    """A path with {key} replaced by values, which may name each other; unknown keys stay as they are.

    Values are resolved first, as often as there are values, so a chain ends and a ring does too.
    """
    known = dict(values)
    for _ in values:
        known = {k: _filled(v, known) for k, v in known.items()}
    for k, v in known.items():
        template = F.replace(template, F.lit("{" + k + "}"), F.lit(v))
    return template


def _filled(text: str, values: dict[str, str]) -> str:
    for k, v in values.items():
        if "{" + k + "}" not in v:
            text = text.replace("{" + k + "}", v)
    return text


def iso_stamp(c: Column) -> Column:
    """A moment as ISO 8601 in UTC."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def language_or_unknown(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("und"))


def joined_list(c: Column) -> Column:
    """A list of a metadata field as one text; empty members go."""
    return F.array_join(F.filter(c, lambda x: x.isNotNull() & (x != "")), "; ")


def clip_type(folder: Column) -> Column:
    """Kind of clips by the folder's name."""
    f = F.lower(folder)
    return F.when(f.contains("filtered"), "filtered").when(f.contains("face"), "face").otherwise("person_clip")


def modality_of(log_name: Column) -> Column:
    return F.when(F.lower(log_name).startswith("image"), "image").otherwise("video")


def without_columns(columns: list[str], dropped: set[str]) -> list[str]:
    """Names that stay, in their order."""
    return [c for c in columns if c not in dropped]
