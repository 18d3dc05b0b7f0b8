"""Column expressions of the row checks. Each returns a Column; none raises on data."""

from __future__ import annotations

import html
import json
from collections.abc import Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def first_filled(*cols: Column) -> Column:
    """The first value that is neither null nor blank, trimmed (release range fill)."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def record_path_ok(p: Column) -> Column:
    """Relative, forward slashes, canonical, below raw/."""
    parts = F.split(p, "/")
    return F.coalesce(p.startswith("raw/") & ~p.contains("\\") & F.forall(parts, lambda s: ~s.isin("", ".", "..")), F.lit(False))


def sha256_ok(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9A-Fa-f]{64}$"), F.lit(False))


def bytes_ok(c: Column, least: int = 0) -> Column:
    return F.coalesce(c >= least, F.lit(False))


def dataset_ok(c: Column) -> Column:
    """Absent is valid; blank or untrimmed is not."""
    return c.isNull() | ((F.trim(c) != "") & (F.trim(c) == c))


def last_segment(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def scope_of(path: Column) -> Column:
    """Second segment of raw/<scope>/<file>, else empty."""
    parts = F.split(path, "/")
    return F.when((F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == "raw"), F.get(parts, F.lit(1))).otherwise("")


def taxid_ok(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9]+$"), F.lit(False))


def hierarchy_id(c: Column) -> Column:
    """The id without its br: mark if it is letters and five digits, else null."""
    bare = F.regexp_replace(F.trim(c), "^(?:br|BR):", "")
    return F.when(bare.rlike("^[A-Za-z]{2,}[0-9]{5}$"), bare)


def pathway_id(c: Column) -> Column:
    """The trimmed id if it is letters and five digits, else null."""
    return F.when(F.trim(c).rlike("^[A-Za-z]{2,}[0-9]{5}$"), F.trim(c))


def organism_code(c: Column) -> Column:
    """Trimmed, lower case, text after ; dropped; null unless letters and digits."""
    code = F.lower(F.trim(F.substring_index(c, ";", 1)))
    return F.when(code.rlike("^[a-z0-9]+$"), code)


def levels_ok(c: Column, allowed: Sequence[str]) -> Column:
    domain = F.array(*[F.lit(x) for x in allowed])
    return F.coalesce(F.forall(F.split(c, ";"), lambda x: F.array_contains(domain, F.trim(x))), F.lit(False))


def in_domain(c: Column, domain: Sequence[str], default: str | None = None) -> Column:
    value = F.lower(F.trim(c))
    if default is not None:
        value = F.coalesce(F.nullif(value, F.lit("")), F.lit(default))
    return F.coalesce(value.isin(list(domain)), F.lit(False))


def _reject(_: str):
    raise ValueError("not JSON")


_STRICT = json.JSONDecoder(parse_constant=_reject, parse_int=str, parse_float=str)


def strict_json(v: str | None) -> bool:
    """Strict JSON; numbers stay text, so their length is no error. Null is not valid."""
    try:
        _STRICT.decode(v)
    except (TypeError, ValueError, RecursionError):
        return False
    return True


@F.pandas_udf(T.BooleanType())
def json_ok(values: pd.Series) -> pd.Series:
    """Strict JSON; a text that a batch repeats is read once."""
    known = {v: strict_json(v) for v in values.unique()}
    return values.map(known.__getitem__).astype(bool)


@F.pandas_udf(T.StringType())
def link_target(values: pd.Series) -> pd.Series:
    """Entity-unescaped, trimmed, without query and fragment, percent-decoded."""
    return values.map(lambda v: None if v is None else unquote(html.unescape(v).strip().split("#")[0].split("?")[0]))


def query_value(c: Column) -> Column:
    """URL-encoded as a query value: space as +, ~ kept, * encoded."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def request_url(base: str, params: dict[str, Column]) -> Column:
    """Parameters by name, values encoded."""
    pairs = [F.concat(F.lit(k + "="), query_value(params[k])) for k in sorted(params)]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *pairs))


def expanded(template: Column, version: Column) -> Column:
    return F.replace(template, F.lit("{version}"), version)


def source_version(version: Column, token: Column) -> Column:
    return F.when(~blank(version) & (version != token), version)


#: Accepted release tokens, as (database, pattern, canonical form); the pattern ignores case where it begins with (?i).
RELEASE_RULES = [
    ("reactome", "(?i)^v?([0-9]+)$", "v$1"),
    ("interpro", "^([0-9]+(?:\\.[0-9]+)?)$", "$1"),
    ("uniprot", "^([0-9]{4}_[0-9]{2})$", "$1"),
    ("kegg", "^([0-9]{4}-[0-9]{2})$", "$1"),
    ("cog", "(?i)^(?:COG)?([0-9]{4})$", "COG$1"),
    ("eggnog", "^5$", "5.0.2"),
    ("eggnog", "^([0-9]+)$", "$1.0.0"),
    ("eggnog", "^([0-9]+\\.[0-9]+\\.[0-9]+)$", "$1"),
    ("interproscan", "^([0-9]{1,4}\\.[0-9]{1,4}-[0-9]{1,4}\\.[0-9]{1,4})$", "$1"),
    ("archive", "^([0-9]{4}-[0-9]{2}-[0-9]{2})$", "$1"),
]
#: Databases whose tokens are months or days of the calendar, with what makes a day of one; and the one whose tokens aren't trimmed.
CALENDAR, UNTRIMMED = {"kegg": "-01", "archive": ""}, "interproscan"


def release_token(database: Column, token: Column) -> Column:
    """The canonical token of a database's release, or null: of another form, no day or month of the calendar, or "current", which is no fixed release."""
    out = F.lit(None).cast("string")
    for name, pattern, form in reversed(RELEASE_RULES):
        t = token if name == UNTRIMMED else F.trim(token)
        real = F.try_to_date(F.concat(t, F.lit(CALENDAR[name])), "yyyy-MM-dd").isNotNull() if name in CALENDAR else F.lit(True)
        out = F.when((database == name) & t.rlike(pattern) & real, F.regexp_replace(t, pattern, form)).otherwise(out)
    return out


#: The line of release notes that names the release.
NOTES_PATTERNS = {"uniprot": "(?m)^UniProt Release ([0-9]{4}_[0-9]{2})\\b", "interpro": "(?m)^Release ([0-9]+(?:\\.[0-9]+)?)\\b"}


def notes_release(text: Column, database: str) -> Column:
    """The release that the first matching line of multi-line notes names, or null."""
    return F.nullif(F.regexp_extract(text, NOTES_PATTERNS[database], 1), F.lit(""))


#: Suffixes of entity files, with their asset and the end of their url.
ENTITY_FILES = {
    "pathway": [(".txt", "pathway.entry", ""), (".kgml", "pathway.kgml", "/kgml"), (".conf", "pathway.conf", "/conf"), (".png", "pathway.image", "/image")],
    "brite": [(".txt", "brite.entry", ""), (".json", "brite.json", "/json")],
}


def entity_file(name: Column, scope: Column, family: str, base_url: str) -> Column:
    """struct(entity_id, asset, url) of a pathway or hierarchy file's name, or null."""
    listed = F.lit(f"{base_url}/list/{family}")
    if family == "pathway":
        url = F.when(scope == "reference", listed).otherwise(F.concat(listed, F.lit("/"), scope))
    else:
        url = F.concat(listed, F.lit("/"), scope)
    out = F.when(name == f"{family}.list.tsv", F.struct(F.lit("").alias("entity_id"), F.lit(f"{family}.list").alias("asset"), url.alias("url")))
    for suffix, asset, end in ENTITY_FILES[family]:
        own = F.regexp_replace(name, suffix.replace(".", "\\.") + "$", "")
        at = F.concat(F.lit(f"{base_url}/get/" + ("br:" if family == "brite" else "")), own, F.lit(end))
        out = out.when(name.endswith(suffix), F.struct(own.alias("entity_id"), F.lit(asset).alias("asset"), at.alias("url")))
    return out


def info_metadata(text: Column) -> Column:
    """struct(release, updated) of an info page: of the lines that name one the last counts, up to the line by which both are known; a day written with slashes gets dashes, any other text stays. Null where there is none."""

    def after(line: Column, mark: str) -> Column:
        rest = F.trim(F.regexp_replace(line, f"^.*?{mark}", ""))
        return F.when(line.contains(mark), F.trim(F.substring_index(rest, ",", 1))).otherwise("")

    def step(a: Column, line: Column) -> Column:
        release, updated = after(line, "Release "), after(line, "Last update ")
        known = (a["release"] != "") & (a["updated"] != "")
        return F.struct(F.when(known | (release == ""), a["release"]).otherwise(release).alias("release"), F.when(known | (updated == ""), a["updated"]).otherwise(updated).alias("updated"))

    lines = F.transform(F.split(text, "\r?\n"), lambda x: F.trim(x))
    found = F.aggregate(lines, F.struct(F.lit("").alias("release"), F.lit("").alias("updated")), step)
    day = F.date_format(F.try_to_date(F.when(found["updated"].rlike("^[0-9]{4}/[0-9]{2}/[0-9]{2}$"), found["updated"]), "yyyy/MM/dd"), "yyyy-MM-dd")
    return F.struct(F.nullif(found["release"], F.lit("")).alias("release"), F.coalesce(day, F.nullif(found["updated"], F.lit(""))).alias("updated"))


def info_release(text: Column) -> Column:
    return info_metadata(text)["release"]


def info_updated(text: Column) -> Column:
    return info_metadata(text)["updated"]


def annotation_name(name: Column) -> Column:
    """struct(dataset, format) of <dataset>.<format>.gz, or null."""
    p = "^([A-Za-z0-9_-]+)\\.(gaf|gpad|gpi)\\.gz$"
    return F.when(name.rlike(p), F.struct(F.regexp_extract(name, p, 1).alias("dataset"), F.regexp_extract(name, p, 2).alias("format")))


def network_asset(name: Column, taxid: Column) -> Column:
    """Asset of <taxid>.<asset>.<version>.txt.gz, or null. What follows the last dot of the middle is the version, whatever its form."""
    begin, end = F.concat(taxid, F.lit(".")), ".txt.gz"
    body = F.substring(name, F.char_length(begin) + 1, F.greatest(F.char_length(name) - F.char_length(begin) - len(end), F.lit(0)))
    asset = F.regexp_extract(body, "^(.+)\\.[^.]*$", 1)
    whole = name.startswith(begin) & name.endswith(end) & (F.char_length(name) >= F.char_length(begin) + len(end))
    return F.when(whole, F.nullif(asset, F.lit("")))


def pathway_set_name(name: Column) -> Column:
    """struct(species, released) of wikipathways-YYYYMMDD-gmt-<species>.gmt, or null."""
    p = "^wikipathways-([0-9]{4})([0-9]{2})([0-9]{2})-gmt-(.+)\\.gmt$"
    date = F.concat_ws("-", *[F.regexp_extract(name, p, k) for k in (1, 2, 3)])
    return F.when(name.rlike(p), F.struct(F.regexp_extract(name, p, 4).alias("species"), date.alias("released")))


def checksum_line(line: Column) -> Column:
    """struct(md5, name) of a checksum file's only line, or null: 32 hexadecimal characters, blanks or tabs, perhaps an asterisk, and a name, which may hold blanks but no slash."""
    p = "^([0-9A-Fa-f]{32})[ \\t]+\\*?([^/\\r\\n]+)(?:\\r?\\n)?$"
    return F.when(line.rlike(p), F.struct(F.lower(F.regexp_extract(line, p, 1)).alias("md5"), F.regexp_extract(line, p, 2).alias("name")))
