"""What both evaluators of the rule language agree on: constants and the meaning of value filters."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

#: Classes that setaccess and addaccess write, each behind a prefix that the caller gives.
ACCESS_CLASSES = ("foot", "bicycle", "car", "delivery", "bus", "taxi", "emergency", "truck")

# Conversion factors and the kilometres of a mile.
FACTORS = {"m=>ft": "3.28084", "ft=>m": "0.3048", "km/h=>mph": "0.621371", "mph=>km/h": "1.609344", "km=>mi": "0.621371"}
MPH = "1.609344"

# ISO 3166 codes of countries that address rules name.
COUNTRIES = {
    "AT": "AUT", "BE": "BEL", "CH": "CHE", "CZ": "CZE", "DE": "DEU", "DK": "DNK", "ES": "ESP", "FI": "FIN", "FR": "FRA", "GB": "GBR", "IE": "IRL", "IT": "ITA",
    "LI": "LIE", "LU": "LUX", "NL": "NLD", "NO": "NOR", "PL": "POL", "PT": "PRT", "SE": "SWE", "SI": "SVN", "SK": "SVK", "US": "USA",
}

NUMBER = r"^\s*(-?\d+(?:\.\d+)?)\s*[A-Za-z/]*\s*$"
SPEED = r"^\s*(\d+(?:\.\d+)?)\s*(mph|km/h|kmh|kph)?\s*$"


def number(text: str | None) -> float | None:
    """The number of a tag value, a unit behind it ignored."""
    m = re.match(NUMBER, text or "")
    return float(m[1]) if m else None


def speed(text: str | None) -> float | None:
    m = re.match(SPEED, text or "")
    return None if not m else float(m[1]) * (float(MPH) if m[2] == "mph" else 1.0)


def whole(x: float) -> str:
    return str(int(Decimal(repr(x)).quantize(Decimal(1), ROUND_HALF_UP)))


def substitution(arg: str) -> tuple[str, str]:
    old, _, new = arg.partition("=>")
    return old, new


def filtered(value: str | None, filters: tuple, tags: dict) -> str | None:
    for name, arg in filters:
        if name == "def":
            value = arg if value is None else value
        elif value is None:
            continue
        elif name == "subst":
            old, new = substitution(arg)
            value = value.replace(old, new)
        elif name == "part":
            sep, _, n = arg.rpartition(":")
            pieces = value.split(sep or ";")
            value = (pieces[int(n) - 1] if 0 < int(n) <= len(pieces) else "") or None
        elif name in ("conv", "height"):
            x = number(value)
            value = None if x is None else whole(x * float(FACTORS[arg]))
        elif name == "not-contained":
            sep, _, key = arg.rpartition(":")
            value = None if tags.get(key) is not None and value in tags[key].split(sep or ";") else value
        elif name == "country-ISO":
            value = COUNTRIES.get(value.upper(), value.upper())
        elif name == "highway-symbol":
            value = f"[{arg.split(':')[0]}]{value}"
        else:
            raise ValueError(f"unknown filter {name!r}")
    return value
