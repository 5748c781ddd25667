"""URL filter: rules by host and path, and gradient-boosted trees for what no rule fits.

The trees are trained on URLs that the rules label (bounded sample), on lexical features: lengths,
depth, digit ratio, entropy, parameter counts, and how often hosts with the same last label and the
same last two labels are blocked among all labelled URLs. These rates are counted over all rows and
joined by suffix, so that they do not depend on the sample. Trees are grown on binned features by the
second-order gain of the logistic loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored
from .words import pieces

#: (allow or block, host, path)
Rule = tuple[str, str, str]
#: about so many labelled urls are used to fit, however many there are
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, RIDGE = 40, 3, 0.2, 32, 1.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SMOOTHING = 5.0


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(act)).otherwise(verdict)
    return name, verdict


def lexical(urls: pa.Array) -> np.ndarray:
    """Length, host length, path depth, digit ratio, entropy, parameters, host labels, marks."""
    out = []
    for first, end, data, offsets in pieces(urls):
        n = end - first
        row = np.repeat(np.arange(n), np.diff(offsets))
        size = np.maximum(np.diff(offsets), 1)
        count = lambda mask: np.bincount(row, mask, minlength=n)
        pair, times = np.unique(row * 256 + data, return_counts=True)
        share = times / size[pair // 256]
        entropy = np.bincount(pair // 256, -share * np.log2(share), minlength=n)
        out.append(
            np.stack(
                [
                    np.diff(offsets),
                    count(data == ord("/")),
                    count((data >= 48) & (data <= 57)) / size,
                    entropy,
                    count((data == ord("&")) | (data == ord("?"))),
                    count(data == ord(".")),
                    count(data == ord("-")),
                    count(data >= 128),
                ],
                axis=1,
            )
        )
    return np.concatenate(out) if out else np.zeros((0, 8))


def _suffix_keys(host: Column) -> list[Column]:
    """The last label of a host and its last two, as keys of the rates."""
    return [F.concat(F.lit(f"{n} "), F.substring_index(host, ".", -n)) for n in (1, 2)]


def _features(urls: pa.Array, hosts: list[str], rates: np.ndarray) -> np.ndarray:
    lengths = np.array([len(h) for h in hosts], float)
    return np.concatenate([lexical(urls), np.asarray(rates, float).reshape(-1, 2), lengths.reshape(-1, 1)], axis=1)


def _grow(x: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple:
    """A tree as nested ``(feature, bound, left, right)`` with values at the leaves."""
    bins = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)

    def node(rows: np.ndarray, depth: int):
        G, H = g[rows].sum(), h[rows].sum()
        best = (1e-6, None, None)
        if depth:
            for f, e in enumerate(edges):
                left_g = np.cumsum(np.bincount(bins[rows, f], g[rows], minlength=len(e) + 1))[:-1]
                left_h = np.cumsum(np.bincount(bins[rows, f], h[rows], minlength=len(e) + 1))[:-1]
                if not len(left_g):
                    continue
                gain = left_g**2 / (left_h + RIDGE) + (G - left_g) ** 2 / (H - left_h + RIDGE) - G**2 / (H + RIDGE)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], f, i)
        if best[1] is None:
            return float(-RATE * G / (H + RIDGE))
        _, f, i = best
        low = bins[rows, f] <= i
        return f, float(edges[f][i]), node(rows[low], depth - 1), node(rows[~low], depth - 1)

    return node(np.arange(len(x)), DEPTH)


def _answer(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, bound, left, right = tree
    low = x[:, f] <= bound
    out = np.empty(len(x))
    out[low], out[~low] = _answer(left, x[low]), _answer(right, x[~low])
    return out


def boost(urls: pa.Array, hosts: list[str], rates: np.ndarray, y: np.ndarray) -> tuple:
    """The base score and the trees; ``rates`` has the two suffix rates of each url."""
    prior = float((y.sum() + 1) / (len(y) + 2))
    x = _features(urls, hosts, rates)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    base = float(np.log(prior / (1 - prior)))
    raw, trees = np.full(len(y), base), []
    for _ in range(TREES if len(y) else 0):
        p = 1 / (1 + np.exp(-raw))
        tree = _grow(x, edges, p - y, p * (1 - p))
        trees.append(tree)
        raw += _answer(tree, x)
    return base, trees


def suffix_rates(labelled: DataFrame) -> tuple[DataFrame, float]:
    """``suffix, rate``: how often urls with the suffix are blocked, drawn towards the share of all, which
    is the rate of suffixes that are not there."""
    blocked = (F.col("act") == "block").cast("long")
    total = labelled.agg(F.coalesce(F.sum(blocked), F.lit(0)).alias("s"), F.count("*").alias("n")).first()
    prior = (total["s"] + 1) / (total["n"] + 2)
    each = labelled.select(F.explode(F.array(*_suffix_keys(F.col("host")))).alias("suffix"), blocked.alias("blocked"))
    sums = each.groupBy("suffix").agg(F.sum("blocked").alias("s"), F.count("*").alias("n"))
    rate = (F.col("s") + F.lit(SMOOTHING * prior)) / (F.col("n") + F.lit(SMOOTHING))
    return stored(sums.select("suffix", rate.alias("rate")), "suffix-rates"), prior


def _with_rates(rows: DataFrame, rates: DataFrame, prior: float) -> DataFrame:
    """Add ``rate_1`` and ``rate_2`` of each row's host."""
    for n, key in enumerate(_suffix_keys(F.col("host")), 1):
        known = rates.select(F.col("suffix").alias("__suffix"), F.col("rate").alias(f"rate_{n}"))
        rows = rows.join(known, key == F.col("__suffix"), "left").drop("__suffix")
    return rows.withColumns({f"rate_{n}": F.coalesce(f"rate_{n}", F.lit(prior)) for n in (1, 2)})


def train(pages: DataFrame, rules: list[Rule], rows: int = TRAIN_ROWS) -> tuple:
    """Suffix rates of all distinct urls that a rule labels, and trees from those picked by hash. The
    sample is bounded, so the driver may hold it: an url, two rates and a label per row."""
    known = pages.select(F.col("url").cast("string").alias("url")).where("url IS NOT NULL").distinct()
    known = known.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    known = known.withColumn("act", rule_of(F.col("host"), F.col("path"), rules)[1]).where("act IS NOT NULL")
    known = stored(known.select("url", "host", "act"), "labelled-urls")
    rates, prior = suffix_rates(known)
    there = known.count()
    if there > rows:
        known = known.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int((1 << 30) * rows / there))
    sample = _with_rates(known, rates, prior).orderBy("url").toPandas()
    y = (sample["act"] == "block").to_numpy(float)
    fitted = boost(pa.array(sample["url"], pa.large_string()), sample["host"].tolist(), sample[["rate_1", "rate_2"]].to_numpy(float), y)
    return rates, prior, *fitted


def judged(pages: DataFrame, rules: list[Rule], model: tuple) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, block_score`` of every page.

    A null url, or one without ``://``, has empty host and path, fits no rule and is judged by the
    trees as an empty text. Repeated rows repeat; other columns are not looked at.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, act = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("act", act)
    rates, prior, base, trees = model
    rows = _with_rates(rows, rates, prior)

    @F.pandas_udf("double")
    def chance(url: pd.Series, host: pd.Series, rate_1: pd.Series, rate_2: pd.Series) -> pd.Series:
        x = _features(pa.array(url, pa.large_string()), host.tolist(), np.stack([rate_1, rate_2], axis=1))
        raw = np.full(len(x), base)
        for tree in trees:
            raw += _answer(tree, x)
        return pd.Series(1 / (1 + np.exp(-raw)))

    scored = rows.withColumn("block_score", chance("url", "host", "rate_1", "rate_2"))
    judged_by = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "url", "host", "path", "rule", F.coalesce("act", judged_by).alias("verdict"), "block_score"
    )
