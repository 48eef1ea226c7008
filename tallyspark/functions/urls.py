"""Column functions over data addresses: identifiers, versions and request addresses.

The dataflow stands between the agency and its version, with commas between them or as parts between slashes. A version
is found without the agency too; one that nothing follows is none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The agency, the services, the format that is asked for and the first year of an open range.
AGENCY = "OECD.DCD.FSD"
BASE_V1 = "https://sdmx.oecd.org/public/rest/data/"
BASE_V2 = "https://sdmx.oecd.org/public/rest/v2/data/dataflow/"
BASE_PROJECTS = "https://sdmx.oecd.org/dcd-public/rest/data/"
FORMAT = "csvfilewithlabels"
FIRST_YEAR = 1950


def _parts(url: Column) -> Column:
    return F.split(url, "/")


# How a version stands in an address, after a comma or between slashes, and how an identifier does before it.
VERSION_LISTED, VERSION_SEATED = ",([0-9]+[.][0-9]+)/", "/([0-9]+[.][0-9]+)/"
ID_LISTED, ID_SEATED = r"OECD\.DCD\.FSD,([^,/]+),[0-9]+[.][0-9]+", r"OECD\.DCD\.FSD/([^/]+)/[0-9]+[.][0-9]+"


def _seat(url: Column) -> Column:
    """The place of the part after the agency's, from 0; null where the agency isn't a part."""
    at = F.array_position(_parts(url), AGENCY).cast("int")
    return F.when(at > 0, at)


def _first(url: Column, *forms: str) -> Column:
    """What the first form that an address has holds; null without any."""
    return F.coalesce(*[F.nullif(F.regexp_extract(url, form, 1), F.lit("")) for form in forms])


def dataflow_id(url: Column) -> Column:
    """The identifier between the agency and a version."""
    return _first(url, ID_LISTED, ID_SEATED)


def dataflow_version(url: Column) -> Column:
    """The version that a slash follows, of whatever agency: after a comma, or else between slashes."""
    return _first(url, VERSION_LISTED, VERSION_SEATED)


def with_version(url: Column, version: str | Column) -> Column:
    """The address with another version; unchanged where it has none."""
    new = F.lit(version) if isinstance(version, str) else version
    listed = F.regexp_replace(url, F.lit(VERSION_LISTED), F.concat(F.lit(","), new, F.lit("/")))
    seated = F.regexp_replace(url, F.lit(VERSION_SEATED), F.concat(F.lit("/"), new, F.lit("/")))
    return F.when(url.rlike(VERSION_LISTED), listed).otherwise(seated)


def flow_id(url: Column) -> Column:
    """The identifier that an address ends with, after the agency."""
    seat = _seat(url)
    rest = F.filter(F.slice(_parts(url), seat + 2, F.size(_parts(url))), lambda p: p != "")
    return F.when((F.size(_parts(url)) > seat) & (F.size(rest) == 0), F.nullif(F.get(_parts(url), seat), F.lit("")))


def _given(value: Column | int | str | None) -> Column:
    """value as text; null where it is none, empty or 0."""
    text = (value if isinstance(value, Column) else F.lit(value)).cast("string")
    return F.when(~text.isin("", "0"), text)


def request_url(dataflow: Column, version: Column | None = None, key: Column | None = None, start: Column | int | None = None, end: Column | int | None = None, last: Column | int | None = None, file_format: str = FORMAT, api_version: int = 1) -> Column:
    """The address of a request: service, dataflow and key (all of it by default), then format, period and the number of
    last observations."""
    newer = api_version == 2
    mark, every = ("/", "*") if newer else (",", "all")
    service = F.when(dataflow.contains("CRS") | dataflow.contains("MULTI"), BASE_PROJECTS).otherwise(BASE_V2 if newer else BASE_V1)
    shown = F.coalesce(version if version is not None else F.lit(None).cast("string"), F.lit("+" if newer else ""))
    low, high = _given(start), _given(end)
    if newer:
        first = F.when(low.isNotNull(), low).when(high.isNotNull(), F.lit(str(FIRST_YEAR)))
        period = [F.concat(F.lit("c[TIME_PERIOD]="), F.concat_ws("+", F.concat(F.lit("ge:"), first), F.concat(F.lit("le:"), high)))]
        period = [F.when(first.isNotNull(), period[0])]
    else:
        period = [F.concat(F.lit("startPeriod="), low), F.concat(F.lit("endPeriod="), high)]
    asked = F.concat_ws("&", F.lit(f"format={file_format}"), *period, F.concat(F.lit("lastNObservations="), _given(last)))
    return F.concat(service, F.lit(AGENCY + mark), dataflow, F.lit(mark), shown, F.lit("/"), F.coalesce(key if key is not None else F.lit(None).cast("string"), F.lit(every)), F.lit("?"), asked)
