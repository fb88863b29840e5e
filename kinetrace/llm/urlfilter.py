"""URL filtering: rules first, then logistic regression on hashed character n-grams.

Training runs on the driver over a small labelled table; judging uses DataFrame
functions only. Weights are whole numbers (fixed point), so that sums do not
depend on their order and any engine gives the same verdict.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.llm.urltable import UNWANTED, WANTED

#: Buckets of the hash (three hex digits of the MD5), lengths of n-grams, fixed-point scale, and the most labelled rows that training takes.
BUCKETS, LENGTHS, SCALE, TRAIN_ROWS = 4096, (3, 4), 1_000_000, 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"



def domain(url: str) -> str:
    """The registered domain of a URL: the last two labels of a host, or a numbered host whole; ports do not count."""
    host = split_url(url)[0].split(":")[0]
    return host if host.replace(".", "").isdigit() else ".".join(host.split(".")[-2:])


def part_of(url: str) -> int:
    """The third of the table that a URL is held out with: all of a domain together, but for the domains shared by many hosts, where the host decides."""
    host, name = split_url(url)[0], domain(url)
    return zlib.crc32((host if name.startswith("example.") else name).encode()) % 3


def labelled(part: int | None = None) -> list[tuple[str, int]]:
    """The labelled URL table: (url, 1 to block or 0 to allow), or the third of its domains that ``part`` (0 to 2) names."""
    rows = [(u, 1) for u in UNWANTED] + [(u, 0) for u in WANTED]
    return [r for r in rows if part is None or part_of(r[0]) == part]


def held_out_figures() -> tuple[float, float]:
    """Precision and recall of blocking over domains that training has not seen, each third in turn."""
    hit = wrong = missed = 0
    for part in range(3):
        weights, bias = train([r for other in range(3) if other != part for r in labelled(other)])
        for url, label in labelled(part):
            said = bias + sum(weights[b] for b in buckets(*split_url(url))) > 0
            hit, wrong, missed = hit + (said and label), wrong + (said and not label), missed + (label and not said)
    return hit / (hit + wrong), hit / (hit + missed)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return rest[:end].translate(str.maketrans(_UPPER, _LOWER)), path[:stop]


def buckets(host: str, path: str) -> list[int]:
    """Buckets of all n-grams of host and path, each marked at both ends and with its field."""
    out = []
    for field, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in LENGTHS:
            out += [int(hashlib.md5((field + text[i : i + n]).encode()).hexdigest()[:3], 16) for i in range(len(text) - n + 1)]
    return out


def train(rows: Iterable[tuple[str | None, int | None]], epochs: int = 300, rate: float = 0.05, ridge: float = 1e-4) -> tuple[list[int], int]:
    """Fixed-point weights of each bucket and the bias, by full-batch gradient descent; null labels are passed over."""
    data = [(buckets(*split_url(u)), y) for u, y in rows if y is not None][:TRAIN_ROWS]
    weights, bias = np.zeros(BUCKETS), 0.0
    if data:
        y = np.array([t for _, t in data], float)
        row = np.repeat(np.arange(len(data)), [len(b) for b, _ in data])
        bucket = np.array([x for b, _ in data for x in b], int)
        share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
        first, second = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        for step in range(1, epochs + 1):
            z = np.bincount(row, weights[bucket], len(data)) + bias
            error = (1 / (1 + np.exp(-z)) - y) * share
            grad = np.append(np.bincount(bucket, error[row], BUCKETS) + ridge * weights, error.sum())
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            move = rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            weights -= move[:-1]
            bias -= move[-1]
    return [round(w * SCALE) for w in weights], round(bias * SCALE)


#: Rules as (verdict, host and path prefix).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


def host_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. Of equally long ones the first listed holds."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Shortest first, so that the longest ends up as the outermost condition.
    for said, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def _grams(field: str, text: Column) -> list[Column]:
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    return [F.transform(F.regexp_extract_all(marked, F.lit(f"(?s)(?=(.{{{n}}}))"), 1), lambda g: F.concat(F.lit(field), g)) for n in LENGTHS]


def judge(df: DataFrame, weights: list[int], bias: int, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Judges each URL: ``id_col``, ``host``, ``path``, ``rule``, ``verdict`` and ``points``.

    ``points`` is the fixed-point log-odds of blocking; above 0 the model says
    block. A null URL or one without ``://`` has an empty host and path, fits no
    rule of a named host, and is judged by the model like any other. Of rules
    of equal length that fit, the first listed holds. Null and repeated ids
    pass through; other columns are not read, whatever their names. One row out
    for each row in; the plan has no shuffle.
    """
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")  # folded into one literal
    named = df.select(F.col(id_col).alias(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    grams = F.concat(*_grams("h", F.col("host")), *_grams("p", F.col("path")))
    bucket = lambda g: F.conv(F.substring(F.md5(g.cast("binary")), 1, 3), 16, 10).cast("int")
    points = F.aggregate(grams, F.lit(bias).cast("bigint"), lambda total, g: total + F.get(table, bucket(g)).cast("bigint"))
    out = named.select(id_col, "host", "path", rule.alias("rule"), said.alias("said"), points.alias("points"))
    return out.select(id_col, "host", "path", "rule", F.coalesce("said", F.when(F.col("points") > 0, "block").otherwise("allow")).alias("verdict"), "points")


def oracle(weights: list[int], bias: int, rules: tuple[tuple[str, str], ...] = RULES) -> str:
    """DuckDB SQL for :func:`judge` over ``pages``."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    fits = {}
    for _, rule in ordered:
        domain, slash, rest = rule.partition("/")
        fits[rule] = f"((host = '{domain}' OR host LIKE '%.{domain}') AND starts_with(path, '{slash + rest}'))"
    name = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r}'" for _, r in ordered) + " END"
    said = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{s}'" for s, r in ordered) + " END"
    grams = " || ".join(f"list_transform(range(1, greatest(1, length({t}) - {n - 2})), lambda i: '{f}' || substr({t}, i, {n}))" for f, t in (("h", "mh"), ("p", "mp")) for n in LENGTHS)
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), scored AS (
  SELECT page_id, host, path, '^' || host || '$' AS mh, '^' || path || '$' AS mp FROM named
), points AS (
  SELECT page_id, host, path, {name} AS rule, {said} AS said,
         CAST(({bias} + coalesce(list_sum(list_transform({grams}, lambda g: w[1 + CAST('0x' || substr(md5(g), 1, 3) AS INT)])), 0)) AS BIGINT) AS points FROM scored, weights
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN points > 0 THEN 'block' ELSE 'allow' END) AS verdict, points FROM points
""".replace("WITH parts", f"WITH weights AS (SELECT {weights} AS w), parts")
