"""Scalar column expressions: blob paths, URLs, capture filters, words. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what Python's str.split() takes for white space, in Java's syntax.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
STAGES = ["01-metadata", "02-snapshots", "03-doctrees", "04-doclines", "05-diffs-raw", "05-diffs-span", "05-diffs-clean", "07-summary-raw", "08-summary-clean", "09-labels"]


def words(text: Column | str) -> Column:
    """White-space tokens of a text; null gives null, a blank text an empty array."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def strip_container(path: Column | str) -> Column:
    """A blob name without a leading container name."""
    return F.regexp_replace(path, "^documents/", "")


def blob_path(path: Column | str) -> Column:
    """struct(stage, company, policy, timestamp, run_id) of a blob name of four or five parts; null for any other name.

    The last part loses its last extension. run_id is null for names of four parts.
    """
    parts = F.split(strip_container(path), "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]*$", "")
    return F.when(
        F.size(parts).isin(4, 5),
        F.struct(
            F.get(parts, F.lit(0)).alias("stage"), F.get(parts, F.lit(1)).alias("company"), F.get(parts, F.lit(2)).alias("policy"),
            F.when(F.size(parts) == 4, stem).otherwise(F.get(parts, F.lit(3))).alias("timestamp"), F.when(F.size(parts) == 5, stem).alias("run_id"),
        ),
    )


def unparse(path: Column) -> Column:
    """The parts of a parsed name joined again; the extension is not part of them."""
    return F.concat_ws("/", path["stage"], path["company"], path["policy"], path["timestamp"], path["run_id"])


def sanitise(part: Column | str) -> Column:
    """A part of a URL as a name: unfit signs become '_', then outer spaces and dots, a leading www. and a trailing .html go."""
    c = F.btrim(F.regexp_replace(part, r'[<>:"/\\|?*]', "_"), F.lit(" ."))
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(c, r"^www\.", ""), r"\.html$", ""), F.lit("")), F.lit("default"))


def policy_of_url(url: Column | str) -> Column:
    """Name of the policy a URL points to: the last part of its path, or the host (with port) where the path is empty or '/'."""
    u = F.regexp_replace(url, r"[?#].*$", "")
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    host = F.when(rest.startswith("//"), F.regexp_extract(rest, r"^//([^/]*)", 1)).otherwise("")
    path = F.when(rest.startswith("//"), F.regexp_replace(rest, r"^//[^/]*", "")).otherwise(rest)
    used = F.when(path.isin("", "/"), host).otherwise(path)
    return sanitise(F.coalesce(F.try_element_at(F.filter(F.split(used, "/"), lambda p: (p != "") & (p != ".")), F.lit(-1)), F.when(used.isNotNull(), F.lit(""))))


# Fixed value: form of an absolute web address.
URL_FORM = r"^(https?|ftp)://(?:[^\s/@]+@)?(?:localhost|\d{1,3}(?:\.\d{1,3}){3}|(?:[\p{L}\p{N}](?:[\p{L}\p{N}_-]{0,61}[\p{L}\p{N}])?\.)+[\p{L}]{2,63})(?::\d{2,5})?(?:[/?#]\S*)?$"


def valid_url(url: Column | str) -> Column:
    return F.coalesce(F.col(url).rlike(URL_FORM) if isinstance(url, str) else url.rlike(URL_FORM), F.lit(False))


def valid_capture(ts: Column, status: Column) -> Column:
    """A capture with a time, and a status of digits that sorts before '400' as text."""
    return F.coalesce((ts != "") & status.rlike(r"^\p{N}+$") & (status < "400"), F.lit(False))


def capture_time(ts: Column) -> Column:
    return F.when(ts.rlike("^[0-9]{14}$"), F.try_to_timestamp(ts, F.lit("yyyyMMddHHmmss")))


def archive_url(ts: Column, original: Column) -> Column:
    return F.concat_ws("/", F.lit("https://web.archive.org/web"), ts, original)


def restage(path: Column | str, old: str, new: str) -> Column:
    return F.replace(path, F.lit(old), F.lit(new))


def label_value(value: Column | str) -> Column:
    """'True' and 'False' as 1 and 0, anything else null."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(c == "True", 1).when(c == "False", 0)


def cdx_rows(raw: Column | str) -> Column:
    """Rows of a capture index (a JSON array of arrays, the first naming the columns) as maps; as zip, cut to the shorter."""
    rows = F.from_json(raw, "array<array<string>>")
    head = rows[0]
    one = lambda r: F.map_from_arrays(F.slice(head, 1, F.least(F.size(head), F.size(r))), F.slice(r, 1, F.least(F.size(head), F.size(r))))
    return F.when(F.size(rows) > 1, F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(1))), one)).otherwise(F.array().cast("array<map<string,string>>"))
