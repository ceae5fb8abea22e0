"""Class codes, sequence keys and derived ids as column expressions.

A pixel's yearly classes are one array, and its sequence key packs them into a
long, one byte per year (at most eight). Keys are compared for equality only;
``ordered`` gives the unsigned order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_YEARS = 8
LAST_CROP = 81
BARREN = 254
GENERAL_BARREN = 45
PIXEL_M = 30
PIXEL_AREA = PIXEL_M * PIXEL_M
ACRE_M2 = 4046.86

# Class -> general class. Classes that are not listed, and those listed with 0, are non-crop.
GENERAL_CLASS = {
    1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 10: 7, 11: 8, 12: 1, 13: 1, 14: 44, 21: 14, 22: 13, 23: 14, 24: 4, 25: 16, 26: 5, 27: 18, 28: 19, 29: 20,
    30: 16, 31: 21, 32: 22, 33: 23, 34: 16, 35: 24, 36: 25, 37: 26, 38: 31, 39: 27, 41: 28, 42: 29, 43: 30, 44: 31, 45: 32, 46: 33, 47: 34, 48: 35, 49: 36, 50: 37,
    51: 38, 52: 39, 53: 40, 54: 41, 55: 42, 56: 43, 57: 44, 58: 0, 59: 0, 60: 0, 61: 45, 63: 0, 64: 0, 65: 0, 66: 46, 67: 46, 68: 46, 69: 47, 70: 0, 71: 0,
    72: 46, 74: 46, 75: 46, 76: 46, 77: 46, 81: 0, 82: 0, 83: 0, 87: 0, 88: 0, 92: 48, 111: 0, 112: 0, 121: 0, 122: 0, 123: 0, 124: 0, 131: 45, 141: 0, 142: 0,
    143: 0, 152: 0, 176: 0, 190: 0, 195: 0, 204: 46, 205: 49, 206: 50, 207: 34, 208: 51, 209: 52, 210: 46, 211: 46, 212: 46, 213: 34, 214: 53, 215: 46, 216: 54, 217: 46, 218: 46,
    219: 55, 220: 46, 221: 56, 222: 57, 223: 46, 224: 31, 225: 1, 226: 1, 227: 58, 228: 1, 229: 59, 230: 13, 231: 52, 232: 2, 233: 14, 234: 13, 235: 14, 236: 4, 237: 1, 238: 4,
    239: 5, 240: 5, 241: 1, 242: 60, 243: 61, 244: 34, 245: 31, 246: 62, 247: 31, 248: 34, 249: 34, 250: 63, 254: 5,
}


def character(point: Column) -> Column:
    """The character of a code point. ``F.char`` knows the first 256 only and begins again behind them."""
    return F.decode(F.unhex(F.lpad(F.hex(point.cast("long")), 8, "0")), "UTF-32")


def general_class(value: Column) -> Column:
    """The general class by a literal table; 0 for what is not listed."""
    table = F.array(*(F.lit(GENERAL_CLASS.get(v, 0)) for v in range(256)))
    return F.coalesce(F.try_element_at(table, value.cast("int") + 1), F.lit(0))


def crop_or_barren(value: Column, exclude_low: bool = False) -> Column:
    """Classes above the crops become BARREN, with ``exclude_low`` also 61 to 65; 0 stays."""
    out = value > LAST_CROP
    if exclude_low:
        out = out | value.between(61, 65)
    return F.when(out, BARREN).otherwise(value).cast("int")


def pack(keys: Column, n_years: int) -> Column:
    """The sequence key of an array of n_years bytes; year i is at bit 8 * i."""
    if not 1 <= n_years <= MAX_YEARS:
        raise ValueError(f"between 1 and {MAX_YEARS} years fit a key, not {n_years}")
    # one loop from the last year down: unrolled over the years it took several times as long
    return F.aggregate(F.reverse(F.slice(keys, 1, n_years)), F.lit(0).cast("bigint"), lambda seq, key: F.shiftleft(seq, 8).bitwiseOR(key.cast("bigint")))


def unpack(seq: Column, n_years: int) -> Column:
    return F.array(*(F.shiftrightunsigned(seq, 8 * i).bitwiseAND(F.lit(255)).cast("int") for i in range(n_years)))


def ordered(seq: Column) -> Column:
    """A long in the unsigned order of keys."""
    return seq.bitwiseXOR(F.lit(-(1 << 63)))


def effective(keys: Column, n_years: int, barren: int = BARREN) -> Column:
    """Years with a class less years that are barren."""
    return F.size(F.filter(F.slice(keys, 1, n_years), lambda key: (key > 0) & (key != barren)))


def shown(value: Column) -> Column:
    """The class as it is given out: BARREN is blanked."""
    return F.when(value == BARREN, 0).otherwise(value).cast("int")


def years_tag(start: int, end: int) -> Column:
    return F.concat(F.substring(F.lit(str(start)), -2, 2), F.substring(F.lit(str(end)), -2, 2))


def field_id(state: Column, tag: Column, number: Column) -> Column:
    return F.concat(state, tag, F.lpad(number.cast("string"), 9, "0"))


def acres(area: Column) -> Column:
    return area / F.lit(ACRE_M2)
