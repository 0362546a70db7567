"""Column functions on bands, labels and probabilities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scene classes that count as cloudy.
SCL_CLOUDY = [0, 1, 3, 7, 8, 9, 10]


def divided(n: Column, d: Column) -> Column:
    return F.try_divide(n.cast("double"), d)


def landsat_cloud(b1: str, b2: str, b3: str) -> Column:
    return F.greatest(b1, b2, b3) > 10000


def scl_cloud(scl: str) -> Column:
    return F.col(scl).isin(SCL_CLOUDY)


def qa_cloud(qa: str) -> Column:
    """Bits 0, 1, 3 and 4: no data, dilated, cloud, shadow."""
    return F.col(qa).bitwiseAND(1 + 2 + 8 + 16) != 0


def argmax(p: Column) -> Column:
    """Position of the largest entry from 0, the lowest of ties."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def rescale_probs(p: Column) -> Column:
    return F.transform(p, lambda x: F.rint(x * 255).cast("int"))


def clip_range(v: Column, lo: float, hi: float) -> Column:
    return ((F.least(F.greatest(v, F.lit(lo)), F.lit(hi)) - lo) * (255 / hi)).cast("int")


def normalize(v: Column, n: float) -> Column:
    return F.least(F.greatest(v, F.lit(0)), F.lit(n)) / n


def multiclass_int(y: Column, n: int, most: float, nan: float) -> Column:
    return F.when(y == nan, n).otherwise(F.least(y / (most / n), F.lit(float(n))).cast("int"))


def multiclass_bins(y: Column, breaks: list[float], nan: float) -> Column:
    out = reduce(lambda acc, i: acc.when(y <= breaks[i], i), range(len(breaks)), F.when(y == nan, len(breaks) + 1))
    return out.otherwise(len(breaks))


def one_hot(y: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == y).cast("int"))


def nan_to_last_class(y: Column, k: int, nan: int) -> Column:
    return y if 0 <= nan < k else F.when(y == nan, k - 1).otherwise(y)


def n_cells(distance: Column, scale: float) -> Column:
    """Cells along a distance; a remainder under 0.001 is none."""
    return F.when(distance % scale < 0.001, F.floor(distance / scale)).otherwise(F.ceil(distance / scale))


#: The band calculator's functions.
CALCULATOR = {
    "abs": F.abs,
    "sqrt": F.sqrt,
    "sum": lambda *b: reduce(lambda x, y: x + y, b),
    "argmax": lambda *b: argmax(F.array(*b)),
    "argmin": lambda *b: argmax(F.transform(F.array(*b), lambda x: -x)),
    "add": lambda a, b: a + b, "subtract": lambda a, b: a - b, "multiply": lambda a, b: a * b,
    "divide": F.try_divide, "minimum": F.least, "maximum": F.greatest, "mean": lambda *b: reduce(lambda x, y: x + y, b) / len(b),
}


def calculate(name: str, *bands: Column) -> Column:
    if name not in CALCULATOR:
        raise ValueError(f"no function {name}")
    return CALCULATOR[name](*bands)


def value_mask(v: Column, value) -> Column:
    return v == value


def rescale_transform(gt: Column, factor: int) -> Column:
    """Geotransform of an image whose cells were split factor times along each side."""
    return gt.withField("scale_x", gt["scale_x"] / factor).withField("scale_y", gt["scale_y"] / factor)
