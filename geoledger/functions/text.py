"""Text normalisation and word rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoledger import constants as C

_BLANKS = " \t\n\r\f\x0b"


def normalize_text(text: Column) -> Column:
    """Lower case, anything but letters and blanks to a space, runs of spaces collapsed, trimmed."""
    letters = F.regexp_replace(F.lower(text), r"[^\p{L}\s]", " ")
    return F.coalesce(F.trim(F.regexp_replace(letters, " {2,}", " "), F.lit(_BLANKS)), F.lit(""))


def is_uninformative(lemma: Column) -> Column:
    return lemma.isin(*C.UNINFORMATIVE_LEMMAS)


def is_derived(lemma: Column) -> Column:
    """Shares its first three letters with an uninformative lemma, both longer than three letters."""
    stems = sorted({word[:3] for word in C.UNINFORMATIVE_LEMMAS if len(word) > 3})
    return (F.length(lemma) > 3) & F.substring(lemma, 1, 3).isin(*stems)


def canonical(lemma: Column) -> Column:
    """Correct a wrong lemma, then fold derived forms."""
    for table in (C.LEMMA_CORRECTIONS, C.FORM_NORMALISATION):
        lookup = F.create_map(*[F.lit(item) for pair in table.items() for item in pair])
        lemma = F.coalesce(F.try_element_at(lookup, lemma), lemma)
    return lemma
