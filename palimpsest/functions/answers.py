"""JSON in model answers: extraction, sanitising, versions of the summary schema and migrations between them."""

from __future__ import annotations

import json
import re
from html import escape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.udfs import arrow_udf

# One object, and one array, with at most one level inside.
OBJECT = r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}"
ARRAY = r"\[[^\[\]]*(?:\[[^\[\]]*\][^\[\]]*)*\]"
_SPACE = re.compile(r"\s+")
RESULT = "success boolean, data string, raw_match string, error string"


def extract(answer: str | None) -> tuple[bool, str | None, str | None, str]:
    """(success, data as JSON text, matched text, error): the whole answer, else its first parsable object, else array."""
    if not answer:
        return False, None, None, "Invalid input: response must be a non-empty string"
    first = matched = None
    for pattern in (None, OBJECT, ARRAY):
        for m in [answer] if pattern is None else re.findall(pattern, answer):
            matched = m
            try:
                return True, json.dumps(json.loads(_SPACE.sub(" ", m).strip()), ensure_ascii=False), m, first or ""
            except (ValueError, RecursionError) as e:
                if pattern and first is None:
                    first = f"JSON decode error:\n{e}"
    return False, None, matched, first or "No valid JSON structure found in response"


@arrow_udf("struct<success:boolean,data:string,raw_match:string,error:string>")
def extract_udf(answer: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([extract(a) for a in answer], columns=["success", "data", "raw_match", "error"])


# Markup that text may keep: tags, their attributes, and schemes of addresses.
KEPT_TAGS = frozenset("a abbr acronym b blockquote code em i li ol strong ul".split())
KEPT_ATTRIBUTES = {"a": ("href", "title"), "abbr": ("title",), "acronym": ("title",)}
_SCHEME = re.compile(r"(?:(?:https?|mailto):|(?![^/?#]*:))", re.I)
_MARKUP = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)((?:\s+[^<>]*)?)/?>")
_ATTRIBUTE = re.compile(r"""([\w-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_BARE = re.compile(r"&(?!#?\w+;)")


def _plain(text: str) -> str:
    return _BARE.sub("&amp;", text).replace("<", "&lt;").replace(">", "&gt;")


def clean_markup(text: str) -> str:
    """A text with harmless markup kept and closed, and all other markup escaped; entities stay as they are."""
    if not ("<" in text or ">" in text or "&" in text):
        return text
    out, last, open_tags = [], 0, []
    for m in _MARKUP.finditer(text):
        tag = m.group(2).lower()
        out.append(_plain(text[last : m.start()]))
        last = m.end()
        if tag not in KEPT_TAGS:
            out.append(_plain(m.group()))
        elif not m.group(1):
            kept = [(k.lower(), "".join(vs)) for k, *vs in _ATTRIBUTE.findall(m.group(3))]
            out.append(f"<{tag}{''.join(f' {k}="{escape(v)}"' for k, v in kept if k in KEPT_ATTRIBUTES.get(tag, ()) and (k != 'href' or _SCHEME.match(v.strip())))}>")
            open_tags.append(tag)
        elif tag in open_tags:  # an end tag closes what is open inside; one without a start says nothing
            while (top := open_tags.pop()) != tag:
                out.append(f"</{top}>")
            out.append(f"</{tag}>")
    out.append(_plain(text[last:]))
    return "".join(out) + "".join(f"</{t}>" for t in reversed(open_tags))


def sanitised(value: object) -> object:
    """Strings at every depth with markup cleaned; all else as it is."""
    if isinstance(value, dict):
        return {k: sanitised(v) for k, v in value.items()}
    if isinstance(value, list):
        return [sanitised(v) for v in value]
    return clean_markup(value) if isinstance(value, str) else value


@arrow_udf("string")
def sanitise_udf(data: pd.Series) -> pd.Series:
    return data.map(lambda d: json.dumps(sanitised(json.loads(d)), indent=2, ensure_ascii=False), na_action="ignore")


FINDING_V1 = "struct<rating:boolean,explanation:string>"
FINDING_V2 = "struct<rating:boolean,reason:string>"
V2 = f"struct<practically_substantive:{FINDING_V2}>"
REGISTRY = {
    "v0": "struct<>",
    "v1": f"struct<legally_substantive:{FINDING_V1},practically_substantive:{FINDING_V1},change_keywords:array<string>,subject_keywords:array<string>,helm_keywords:array<string>>",
    "v2": V2,
    "v3": f"struct<chunks:array<{V2}>>",
}


def valid_for(version: Column, data: Column) -> Column:
    """Whether an answer fits the schema it is said to follow; an unknown version fits none."""
    one, two, three = (F.from_json(data, REGISTRY[v], {"mode": "PERMISSIVE"}) for v in ("v1", "v2", "v3"))
    whole2 = lambda x: x["practically_substantive"]["rating"].isNotNull() & x["practically_substantive"]["reason"].isNotNull()
    finding1 = lambda x: x["rating"].isNotNull() & x["explanation"].isNotNull()
    lists = one["change_keywords"].isNotNull() & one["subject_keywords"].isNotNull() & one["helm_keywords"].isNotNull()
    good = (
        F.when(version == "v0", F.get_json_object(data, "$").isNotNull())
        .when(version == "v1", finding1(one["legally_substantive"]) & finding1(one["practically_substantive"]) & lists)
        .when(version == "v2", whole2(two))
        .when(version == "v3", three["chunks"].isNotNull() & ~F.exists(three["chunks"], lambda x: ~F.coalesce(whole2(x), F.lit(False))))
    )
    return F.coalesce(good, F.lit(False))


def v1_to_v2(v1: Column) -> Column:
    p = v1["practically_substantive"]
    return F.struct(F.struct(p["rating"].alias("rating"), p["explanation"].alias("reason")).alias("practically_substantive"))


def v2_to_v3(v2: Column) -> Column:
    return F.struct(F.array(v2).alias("chunks"))


def to_v3(version: Column, data: Column) -> Column:
    """Any version's answer as v3. Every version other than v1 and v2 is taken to be v3 already."""
    one, two = F.from_json(data, REGISTRY["v1"]), F.from_json(data, REGISTRY["v2"])
    return F.when(version == "v1", v2_to_v3(v1_to_v2(one))).when(version == "v2", v2_to_v3(two)).otherwise(F.from_json(data, REGISTRY["v3"]))


def chunk_record(record: Column) -> Column:
    """A list of JSON-encoded chunk records (encoded twice) as an array of structs."""
    one = "struct<company:string,policy:string,version_ts:string,chunk_idx:int,text:string>"
    return F.transform(F.from_json(record, "array<string>"), lambda x: F.from_json(x, one))
