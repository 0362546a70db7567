"""Bands of the platforms and spectral indices."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each platform's code of a common band name; names left out have no band there.
BANDS = {
    "SENTINEL_2": {
        "coastal": "B01", "blue": "B02", "green": "B03", "red": "B04", "vre1": "B05", "vre2": "B06", "vre3": "B07",
        "nir1": "B08", "nir2": "B8A", "wv": "B09", "cirrus": "B10", "swir1": "B11", "swir2": "B12",
    },
    "LANDSAT_8": {
        "coastal": "B1", "blue": "B2", "green": "B3", "red": "B4", "nir1": "B5", "cirrus": "B9", "swir1": "B6",
        "swir2": "B7", "pan": "B8", "tirsi": "B10", "tirsii": "B11",
    },
    "LANDSAT_7": {
        "blue": "B1", "green": "B2", "red": "B3", "nir1": "B4", "swir1": "B5", "swir2": "B7", "pan": "B8",
        "tirsi": "B6", "tirsii": "B6",
    },
}
BANDS["LANDSAT_5"] = BANDS["LANDSAT_4"] = {k: v for k, v in BANDS["LANDSAT_7"].items() if k != "pan"}
BANDS["LANDSAT_3"] = BANDS["LANDSAT_2"] = BANDS["LANDSAT_1"] = {"green": "B4", "red": "B5", "nir1": "B6", "nir2": "B7"}

# Formulas of the indices, or the three bands that a picture shows.
INDICES = {
    "infrared": "nir1,red,green",
    "rgb": "red,green,blue",
    "swi": "swir2,nir1,red",
    "agriculture": "swir1,nir1,blue",
    "geology": "swir2,swir1,blue",
    "bathymetric": "red,green,coastal",
    "ndvi": "(nir1-red)/(nir1+red)",
    "ndmi": "(nir1-swir1)/(nir1+swir1)",
    "ndwi1": "(green-swir1)/(green+swir1)",
    "ndwi2": "(green-nir1)/(green+nir1)",
    "nhi": "(swir1-green)/(swir1+green)",
    "savi": "(nir1-red)/(nir1+red+0.5)*(1.0+0.5)",
    "gdvi": "nir1-green",
    "evi": "2.5*(nir1-red)/(nir1+6*red-7.5*blue)+1",
    "nbr": "(nir1-swir2)/(nir1+swir2)",
    "bai": "(blue-nir1)/(nir1+blue)",
    "chlorogreen": "nir1/(green+vre1)",
}
# Bands listed for an index where its formula names others.
LISTED = {"swi": ["swir1", "nir1", "red"], "chlorogreen": ["nir1", "green", "vre3"]}


def _formula(index: str) -> str:
    if index not in INDICES:
        raise ValueError(f"no index {index}")
    return INDICES[index]


def index_bands(index: str, platform: str) -> dict[str, str]:
    """The platform's bands listed for an index. A band that it lacks is an error."""
    names = LISTED.get(index) or list(dict.fromkeys(re.findall(r"[a-z][a-z0-9]*", _formula(index))))
    lacking = [n for n in names if n not in BANDS[platform]]
    if lacking:
        raise ValueError(f"{platform} has no band {', '.join(lacking)}")
    return {n: BANDS[platform][n] for n in names}


def spectral_index(index: str, platform: str = "SENTINEL_2") -> Column:
    """An index over columns named by band code; NULL where a divisor is 0, a struct of three bands for a picture."""
    bands, formula = BANDS[platform], _formula(index)
    lacking = [n for n in re.findall(r"[a-z][a-z0-9]*", formula) if n not in bands]
    if lacking:
        raise ValueError(f"{platform} has no band {', '.join(lacking)}")
    if "," in formula:
        return F.struct(*[F.col(bands[n]).alias(n) for n in formula.split(",")])
    guarded = re.sub(r"/\(([^()]*)\)", r"/nullif(\1, 0)", formula)
    return F.expr(re.sub(r"[a-z][a-z0-9]*\b(?!\()", lambda m: f"cast({bands[m[0]]} as double)", guarded))
