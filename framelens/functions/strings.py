"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The marks that a clean name has underscores for.
NAME_MARKS = r"[|@#!¡·$€%&()=?¿^*;:,¨`><+]"


def clean_name(s: Column) -> Column:
    return F.regexp_replace(s, NAME_MARKS, "_")


def label_path(image_path: Column, suffix: str = ".txt") -> Column:
    """The label file of an image: the last /images/ becomes /labels/, and the extension changes."""
    swapped = F.regexp_replace(image_path, r"^(.*)/images/", "$1/labels/")
    return F.concat(F.regexp_replace(swapped, r"\.[^./]*$", ""), F.lit(suffix))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def folder_class(path: Column) -> Column:
    """The class of a folder-per-class file: its parent's name."""
    return F.element_at(F.split(path, "/"), -2)


def six_digits(v: Column) -> Column:
    """A number with at most six significant digits, without trailing zeros."""
    power = F.floor(F.log10(F.nullif(F.abs(v), F.lit(0.0))))
    plain = F.bround(v * F.pow(F.lit(10.0), 5 - power)) / F.pow(F.lit(10.0), 5 - power)
    text = F.regexp_replace(F.regexp_replace(F.format_string("%.10f", plain), r"0+$", ""), r"\.$", "")
    small = F.regexp_replace(F.lower(F.format_string("%.5e", v)), r"\.?0+e", "e")
    return F.when(v == 0, "0").when((power < -4) | (power >= 6), small).otherwise(text)


def count_phrase(n: Column, name: Column) -> Column:
    """'2 cars' or '1 car'."""
    return F.concat(n.cast("string"), F.lit(" "), name, F.when(n > 1, "s").otherwise(""))
