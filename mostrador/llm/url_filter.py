"""URL filters (operator 12): rules, and decisions that spread over redirects and canonical links.

A rule is a host, which stands for its subdomains too, and the beginning of a path; of the rules that fit an address the longest
decides it. Addresses that a page names as its own (``<link rel=canonical>``), or sends the reader to (``<meta
http-equiv=refresh>``, or a table of redirects), are aliases. Connected components join aliases to classes, and an address
without a rule gets the decision of its class: allow if a rule allows any address of it, else block if a rule blocks one.
Addresses that only occur as a target count as well.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.session import settle

from .common import join_unique
from .components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules that are part of the plan; more of them are joined by host.
IN_PLAN = 500


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow")
)

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Where something begins that matters: a comment, an element whose content is no markup, or one that names an address.
_BEGIN = re.compile(r"<(?:(!--)|(?:(script|style|textarea|title|template|xmp|iframe|noembed|noframes)|(link|meta|base))(?=[\s/>]))", re.I)
_ATTRIBUTE = re.compile(r"[\s/]*([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_REFRESH = re.compile(r"\s*[0-9.]+\s*[;,\s]\s*(?:url\s*=\s*)?(.+)", re.I | re.S)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty where there is none, and for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, _ADDRESS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #``."""
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def address(url: Column) -> Column:
    """The form in which addresses are compared: scheme and host lower-cased, no fragment; null without a host."""
    scheme = F.translate(F.trim(F.regexp_extract(url, r"(?s)^(.*?)://", 1)), UPPER, LOWER)
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(scheme, F.lit("://"), host_of(url), path_of(url), query))


def _rule_values(rules: Sequence[Rule]) -> list[tuple]:
    """(host, path, verdict), the rule that wins first: by length, then by length of host, then by text."""
    ordered = sorted(set(rules), key=lambda r: (-len(r.name), -len(r.host), r.name, r.verdict))
    return [(r.host.translate(str.maketrans(UPPER, LOWER)), r.path, r.verdict) for r in ordered]


def _first_fit(listed: Column) -> Column:
    """The first rule of an array (host, path, verdict) that fits the columns host and path."""

    def fits(rule: Column) -> Column:
        inside = (F.col("host") == rule["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), rule["host"]))
        return inside & F.startswith(F.col("path"), rule["path"])

    return F.get(F.filter(listed, fits), 0)


def decide(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``df``, a table with columns host and path, with rule (its name) and decision of the rule that fits best, else null.

    Some hundred rules are a constant of the plan. A longer list becomes a table: the suffixes of the distinct hosts are joined
    with it, and every row gets the rules that its host can meet.
    """
    values = _rule_values(rules)
    kind = "array<struct<host:string,path:string,verdict:string>>"
    if len(values) <= IN_PLAN:
        structs = [F.struct(*(F.lit(v).alias(n) for v, n in zip(value, ("host", "path", "verdict")))) for value in values]
        found = df.withColumn("met", _first_fit(F.array(*structs).cast(kind)))
    else:
        table = df.sparkSession.createDataFrame(
            [(k, *value) for k, value in enumerate(values)], "k bigint, host string, path string, verdict string"
        )
        labels = F.split("host", r"\.")
        suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        hosts = df.select("host").distinct().select("host", F.explode(suffixes).alias("suffix"))
        met = hosts.join(table.withColumnRenamed("host", "suffix"), "suffix")
        of_host = met.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("k", "suffix", "path", "verdict"))).alias("listed"))
        of_host = of_host.withColumn(
            "listed", F.transform("listed", lambda r: F.struct(r["suffix"].alias("host"), r["path"].alias("path"), r["verdict"].alias("verdict")))
        )
        found = join_unique(df, of_host, "host")
        found = found.withColumn("met", _first_fit(F.coalesce("listed", F.array().cast(kind)))).drop("listed")
    return found.select(
        *df.columns, F.concat(F.col("met.host"), F.col("met.path")).alias("rule"), F.col("met.verdict").alias("decision")
    )


def declared(page: str, url: str) -> list[str]:
    """The addresses a page names as canonical or refreshes to, in full; comments, scripts and the like are skipped."""
    found, base, at = [], url, 0
    while begin := _BEGIN.search(page, at):
        comment, raw, tag = begin[1], begin[2], (begin[3] or "").lower()
        if comment:
            end = page.find("-->", begin.end() - 2)
            at = end + 3
        elif raw:
            closing = re.compile(f"</{raw}", re.I).search(page, begin.end())
            end = closing.start() if closing else -1
            at = end + 1
        else:
            end, at, said = 0, begin.end(), {}
            while part := _ATTRIBUTE.match(page, at):
                at = part.end()
                said.setdefault(part[1].lower(), references.unescape((part[2] or "").strip("\"'")).strip())
            target = None
            if tag == "base" and base == url and said.get("href"):
                base = _joined(url, said["href"]) or url
            elif tag == "link" and "canonical" in said.get("rel", "").lower().split():
                target = said.get("href")
            elif tag == "meta" and said.get("http-equiv", "").lower() == "refresh":
                content = _REFRESH.match(said.get("content", ""))
                target = content and content[1].strip().strip("\"'").strip()
            if target and (whole := _joined(base, target)):
                found.append(whole)
        if end < 0:
            break
    return found


def _joined(base: str, target: str) -> str | None:
    try:
        return urljoin(base, target)
    except ValueError:  # a malformed host
        return None


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        here, there = [], []
        for url, page in zip(batch.column("url"), batch.column("html")):
            targets = declared(page.as_py(), url.as_py())
            here += [url.as_py()] * len(targets)
            there += targets
        yield pa.RecordBatch.from_arrays([pa.array(here, pa.string()), pa.array(there, pa.string())], ["here", "there"])


def alias_links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Pairs (here, there) of different addresses that stand for the same page, from columns url and html.

    ``redirects`` has columns from_url and to_url. Only pages that can name an address reach Python.
    """
    able = pages.where(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|refresh"))
    found = able.select("url", "html").mapInArrow(_links, "here string, there string")
    if redirects is not None:
        found = found.unionByName(redirects.select(F.col("from_url").alias("here"), F.col("to_url").alias("there")))
    whole = found.select(address(F.col("here")).alias("here"), address(F.col("there")).alias("there"))
    return whole.where("here <> there").distinct()


def blocked_aliases(links: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Addresses (column key, their MD5) of classes in which a rule blocks an address and none allows one."""
    nodes = links.select("here").unionByName(links.select(F.col("there").alias("here"))).distinct()
    nodes = nodes.select(F.md5("here").alias("key"), host_of(F.col("here")).alias("host"), path_of(F.col("here")).alias("path"))
    roots = components(links.select(F.md5("here").alias("a"), F.md5("there").alias("b")))
    roots = roots.select(F.col("node").alias("key"), "root")
    judged = decide(settle(nodes, "nodes"), rules).where("decision IS NOT NULL").select("key", "decision").join(roots, "key")
    classes = judged.groupBy("root").agg(F.max(F.col("decision") == "allow").alias("allowed")).where("NOT allowed")
    members = join_unique(settle(roots, "roots"), settle(classes, "classes"), "root")
    return members.where("allowed IS NOT NULL").select("key")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    redirects: DataFrame | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict (allow or block), alias (the verdict comes from the class).

    A page that a rule fits has the verdict of the longest. The others are blocked if their class is, else allowed. A null
    address, or one without ``://``, has empty host and path and no aliases; a null page names no address; repeated rows and
    addresses are judged each; no pages give no rows; other columns are ignored.
    """
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"), F.col(f"`{html_column}`").alias("html")
    )
    links = settle(alias_links(rows, redirects), "aliases")
    addresses = rows.select("id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if len(set(rules)) > IN_PLAN:
        addresses = settle(addresses, "addresses")
    judged = decide(addresses, rules)
    if links.isEmpty():
        judged = judged.withColumn("alias", F.lit(False))
    else:
        blocked = settle(blocked_aliases(links, rules).withColumn("alias", F.lit(True)), "blocked")
        judged = settle(judged.withColumn("key", F.md5(address(F.col("url")))).drop("url"), "judged")
        judged = join_unique(judged, blocked, "key")
        judged = judged.withColumn("alias", F.col("decision").isNull() & F.coalesce("alias", F.lit(False)))
    verdict = F.coalesce("decision", F.when(F.col("alias"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select(F.col("id").alias(id_column), "host", "path", "rule", verdict.alias("verdict"), "alias")
