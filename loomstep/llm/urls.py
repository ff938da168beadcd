"""URL filters: rules for hosts and paths, and character models of accepted and rejected URLs for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstep.llm.charmodel import codes, gram_counts, held_steps, log_ratio_table, mean_log_ratio, threshold
from loomstep.llm.common import discard, materialize
from loomstep.schema import free_names

#: Host and path, and what happens to URLs that they fit.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Letters count alike in either case, digits as 0 and _ as - before this alphabet is applied.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-?"
SIZE = len(ALPHABET) + 1
#: Characters of context at most.
ORDER = 3
#: One of so many hosts is held out, with all of its labelled URLs, for the calibration.
HELD_OUT = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there up to `?`, `#` or the end."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, F.lit("://"))
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, upper, lower), path


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule whose host is the URL's or above it and whose path begins the URL's; or null."""
    out = None
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r)):
        h, _, p = rule.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def unruled(url: Column, host: Column, path: Column, rule: Column) -> Column:
    """A URL without the part that its rule looked at: the end of the host and the beginning of the path. A null rule leaves it whole."""
    text, own = F.coalesce(url, F.lit("")), F.coalesce(rule, F.lit(""))
    h = F.length(F.substring_index(own, "/", 1))
    scheme = F.length(F.substring_index(text, "://", 1)) + 3
    left = F.substring(text, F.lit(1), scheme + F.length(host) - h)
    right = F.substring(text, scheme + F.length(host) + F.length(own) - h + 1, F.length(text))
    return F.when(own == "", text).otherwise(F.concat(left, right))


def url_codes(url: Column) -> Column:
    plain = F.lower(F.coalesce(url, F.lit("")))
    return codes(F.translate(plain, "123456789_", "000000000-"), ALPHABET)


def judge(
    pages: DataFrame,
    *,
    url_col: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    label: Column | None = None,
) -> DataFrame:
    """pages with host, path, rule, score and verdict (allow or block); other columns and repeated rows stay.

    A rule's verdict stands. The others get the models': log-likelihood of the whole URL under the model of accepted
    URLs less that under the model of rejected ones, per character, against a threshold that makes the mean of both
    error rates smallest on the whole URLs of held-out hosts (of equal ones the middle); where hosts are so few that
    those held out have one label alone, on all labelled whole URLs. Labels (1 accepted, 0 rejected,
    null neither) are the rules' verdicts unless label is given; all labelled rows count, each distinct URL once. From
    what a rule decided the models learn all but the part that this rule looked at (see unruled()), or they would learn
    the rules. Null and empty URLs have empty host and path and score 0. Without labels of both kinds the models allow
    all. An empty table gives no rows. Columns of pages named like the new ones are replaced, all others stay.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "score", "verdict")]
    own, y, found, t = free_names(pages, "url", "y", "rule", "t")
    url = F.col(f"`{url_col}`")
    rows = pages.select(*(F.col(f"`{c}`") for c in keep), url.alias(own), *([label.alias(y)] if label is not None else []))
    host, path = host_and_path(F.col(own))
    rows = rows.withColumn("host", host).withColumn("path", path).withColumn(found, rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.col(found)["verdict"]
    if label is None:
        rows = rows.withColumn(y, F.when(verdict == "allow", 1).when(verdict == "block", 0))
    known = rows.where(F.col(y).isNotNull() & F.col(own).isNotNull())
    known = known.select(F.col(own).alias("url"), "host", "path", F.col(found)["rule"].alias("rule"), F.col(y).alias("y")).distinct()
    out = F.pmod(F.xxhash64("host"), F.lit(HELD_OUT)) == 0
    learnt = F.col("url") if label is not None else unruled(F.col("url"), F.col("host"), F.col("path"), F.col("rule"))
    known = known.select("y", url_codes(learnt).alias("c"), url_codes(F.col("url")).alias("whole"), out.alias("out"))
    known = materialize(known, "known")
    counts = materialize(gram_counts(known.where("not out"), "y", "c", ORDER, SIZE), "grams")
    table = log_ratio_table(counts, "y", ORDER, SIZE)
    discard(counts)
    score = lambda frame, c: frame.withColumn(t, table.scalar()).withColumn("score", mean_log_ratio(c, F.col(t), ORDER, SIZE))
    steps = held_steps(score(known.where("out"), F.col("whole")), "y", F.col("score"))
    if not all(any(n[k] for n in steps.values()) for k in (0, 1)):
        steps = held_steps(score(known, F.col("whole")), "y", F.col("score"))
    least = threshold(steps)
    discard(known)
    done = score(rows, url_codes(F.col(own)))
    final = F.coalesce(verdict, F.when(F.col("score") >= least, "allow").otherwise("block"))
    return done.select(*(f"`{c}`" for c in keep), "host", "path", F.col(found)["rule"].alias("rule"), "score", final.alias("verdict"))
