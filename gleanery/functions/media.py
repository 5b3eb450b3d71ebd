"""Pixel hashes, payload checks and seasons as columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest width, height and size of a photo, and the grey range below which it is as good as empty.
MIN_WIDTH, MIN_HEIGHT, MIN_BYTES, MIN_RANGE = 150, 150, 200, 3
ACCEPTED = {"JPEG": "image/jpeg", "PNG": "image/png", "WEBP": "image/webp"}


def pack_bits(bits: Column) -> Column:
    """An array of booleans, the first as the highest bit, as a signed 64-bit number."""
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b.cast("bigint")))


def average_hash(pixels: Column) -> Column:
    """Bit = pixel above the mean, over 64 grey values; the mean is summed in order."""
    mean = F.aggregate(pixels, F.lit(0.0), lambda acc, x: acc + x.cast("double")) / F.size(pixels)
    return pack_bits(F.transform(pixels, lambda x: x.cast("double") > mean))


def difference_hash(pixels: Column, width: int = 9) -> Column:
    """Bit = pixel brighter than its right neighbour, over rows of ``width`` grey values."""
    rows = F.floor(F.size(pixels) / width).cast("int")
    at = lambda i: F.get(pixels, i)
    index = F.filter(F.sequence(F.lit(0), rows * width - 1), lambda i: i % width != width - 1)
    return pack_bits(F.transform(index, lambda i: at(i) > at(i + 1)))


def bin_counts(bins: Column, n: int = 64) -> Column:
    """How often each of 0 to ``n`` - 1 stands in an array, as an array of counts; null for a null or empty one."""

    @F.pandas_udf("array<bigint>")
    def counts(lists: pd.Series) -> pd.Series:
        return lists.map(lambda found: None if found is None or not len(found) else np.bincount(found, minlength=n))

    return counts(bins)


def histogram_hashes(counts: Column) -> Column:
    """(ahash, dhash) of 64 counts: bit = count above the mean, and count above that of the next bin, the first after the last. Whole numbers throughout."""

    @F.pandas_udf("ahash bigint, dhash bigint")
    def hashes(lists: pd.Series) -> pd.DataFrame:
        own = lists.dropna()
        px = np.array(own.tolist(), "int64").reshape(-1, 64)
        packed = lambda bits: pd.Series(np.packbits(bits, axis=1).view(">i8").ravel().astype("int64"), own.index, "Int64").reindex(lists.index)
        return pd.DataFrame({"ahash": packed(px * 64 > px.sum(axis=1, keepdims=True)), "dhash": packed(px > np.roll(px, -1, axis=1))})

    return hashes(counts)


def from_hex(digits: Column) -> Column:
    """Unsigned 64-bit hexadecimal as the signed number with the same bits."""
    return F.conv(digits, 16, -10).cast("bigint")


def to_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def season(month: Column, given: Column | None = None) -> Column:
    """Meteorological season of a month's text, a given season first; text that is no number as it is; null out of range."""
    m = month.cast("string").try_cast("int")
    out = F.when(month.isNull(), None).when(m.isNull(), month.cast("string"))
    for name, months in (("winter", (12, 1, 2)), ("spring", (3, 4, 5)), ("summer", (6, 7, 8)), ("autumn", (9, 10, 11))):
        out = out.when(m.isin(*months), name)
    return out if given is None else F.coalesce(F.nullif(given, F.lit("")), out)


def sniff(data: Column) -> Column:
    """Image format by magic bytes, null for none known."""
    h = F.hex(F.substring(data, 1, 12))
    out = F.when(h.startswith("89504E470D0A1A0A"), "PNG").when(h.startswith("FFD8"), "JPEG")
    out = out.when(h.startswith("52494646") & (F.substring(h, 17, 8) == "57454250"), "WEBP")
    out = out.when(h.startswith("474946383761") | h.startswith("474946383961"), "GIF").when(h.startswith("424D"), "BMP")
    return out.when(F.substring(h, 1, 8).isin("00000100", "49492A00", "4D4D002A"), "OTHER")


def html_like(text: Column) -> Column:
    """Whether a payload (as text) looks like a page: of the first 2,048 characters, after white space, a < or a page's tags early on."""
    head = F.regexp_replace(F.substring(text, 1, 2048), r"^[\x00 \t\r\n﻿]+", "")
    low = F.lower(F.substring(head, 1, 512))
    return low.startswith("<") | low.rlike("<!doctype|<html|<head|<body")


def validate(data: Column, declared: Column, width: Column, height: Column, grey_range: Column) -> Column:
    """The first rule that a payload breaks, ``ok`` for none. ``width`` and the others come from decoding; null
    means that it failed."""
    size = F.length(data)
    kind = sniff(data)
    said = F.trim(F.lower(F.get(F.split(declared, ";"), F.lit(0))))
    said = F.when(said == "image/jpg", "image/jpeg").otherwise(said)
    mime = F.coalesce(*[F.when(kind == k, v) for k, v in ACCEPTED.items()])
    out = F.when(data.isNull() | (size == 0), "corrupt").when(html_like(F.decode(F.substring(data, 1, 2600), "ISO-8859-1")), "html_error_page")
    out = out.when(kind.isNull() | ~kind.isin(*ACCEPTED), "unsupported_format").when(size < MIN_BYTES, "tiny_bytes")
    out = out.when((F.coalesce(said, F.lit("")) != "") & (said != mime), "mime_mismatch").when(width.isNull() | height.isNull(), "decode_error")
    return out.when((width < MIN_WIDTH) | (height < MIN_HEIGHT), "tiny").when(grey_range < MIN_RANGE, "near_empty").otherwise("ok")


def image_policy(frames: Column, width: Column, height: Column, size: Column, short_side: int = 320, box: int = 1536, max_bytes: int = 3_000_000) -> Column:
    """The first rule of the suite's image policy that a photo's metadata break, null for none."""
    scale = F.least(F.lit(1.0), box / F.greatest(width, height))
    fitted = F.least(F.greatest(F.lit(1), F.round(width * scale)), F.greatest(F.lit(1), F.round(height * scale)))
    out = F.when(frames != 1, "animated_or_multiframe").when(F.least(width, height) < short_side, "source_resolution_below_320")
    return out.when(fitted < short_side, "aspect_ratio_too_extreme").when(size > max_bytes, "normalized_image_exceeds_3MB")
