"""URL filters: rules and listed sites looked up in a sorted array of digests.

Method: a rule is a host (with all its subdomains) and the start of a path; its key is the
xxhash64 of `host` + path. Each url has few candidate keys: its host's endings, each with
the starts of its path that have the length of some rule's path. The rules' keys are sorted
and written to a file, which is memory-mapped as one array of 64-bit numbers and probed
with all candidates of a batch by a vectorised binary search; a hit counts only if the
stored string equals the candidate, so collisions of hashes can't decide.

The array is dealt out by key: each task sorts and maps only its own range of the rules and
gets the candidates of that range, each different candidate once, however many urls have
it. A list of any size is never on the driver nor broadcast. The mapped file is a task's
own scratch, unlinked as soon as it is opened; nothing reads it but that task.

Cases: a null url, or one without `://`, has an empty host and path and fits no rule.
Hosts are lower-cased A-Z, paths are not. Of fitting rules the longest decides, then the
longer host, then `allow`. Repeated rows are each judged. Repeated rules count once; null
hosts are no rules. Empty tables give empty results, or the default verdict for all urls.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import stored

ALLOW, BLOCK = "allow", "block"
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), A_TO_Z, A_TO_Z.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: Column, head: Column, lengths: list[int]) -> Column:
    """All rules that could fit: endings of the host by labels, with starts of the path.

    `head` is the path up to the longest rule's length."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    sized = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(head))
    starts = F.transform(sized, lambda n: F.substr(head, F.lit(1), n))
    return F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda p: F.concat(h, p))))


def _probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, is_probe, site, verdict, host_length, listed), rules before probes and in order of the digest,
    to (site, verdict, host_length, listed) of the rules that a probe equals."""
    names = ["site", "verdict", "host_length", "listed"]
    parts: list[pa.RecordBatch] = []
    keys = table = None
    with tempfile.TemporaryFile() as file:
        for batch in batches:
            probes = batch.column(1).to_numpy(zero_copy_only=False)
            first = int(np.searchsorted(probes, True))
            if first:
                parts.append(batch.slice(0, first))
                np.ascontiguousarray(batch.column(0).slice(0, first).to_numpy(), "<i8").tofile(file)
            if first == len(batch):
                continue
            if table is None:
                table = pa.Table.from_batches(parts, batch.schema)
                file.flush()
                keys = np.memmap(file, "<i8", "r", shape=(len(table),)) if len(table) else np.empty(0, "<i8")
            batch = batch.slice(first)
            wanted = batch.column(0).to_numpy()
            low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            # Equal digests are next to each other; each is confirmed by its string.
            at = np.repeat(np.arange(len(wanted)), high - low)
            hit = np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange(len(at))
            sites, rules = batch.column(2).take(pa.array(at)), table.take(pa.array(hit))
            same = pa.compute.equal(sites, rules.column("site").combine_chunks())
            rules = rules.filter(same)
            yield from rules.select(names).to_batches()


def rule_table(rules: DataFrame, host: str = "host", path: str = "path", verdict: str = "verdict",
               listed: bool = False) -> DataFrame:
    """(site, rule, verdict, host_length, path_length, listed). Listed sites decide only
    where no rule fits, and name none."""
    name = F.concat(F.col("h"), F.col("p"))
    return (rules.where(col(host).isNotNull())
            .select(F.translate(col(host), A_TO_Z, A_TO_Z.lower()).alias("h"),
                    F.coalesce(col(path), F.lit("")).alias("p"), col(verdict).alias("verdict"))
            .groupBy("h", "p").agg(F.min("verdict").alias("verdict"))
            .select(name.alias("site"), F.length("h").alias("host_length"), F.length("p").alias("path_length"),
                    "verdict", F.lit(listed).alias("listed")))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url: str = "url",
               default: str = ALLOW) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule (the one that decides, else
    null), verdict, listed (a listed site decided). `rules` as from `rule_table`."""
    rules = stored(rules)
    lengths = sorted(r[0] for r in rules.select("path_length").distinct().collect())
    longest = max(lengths, default=0)
    urls = pages.select(col(id_col).alias("page_id"), col(url).alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    head = F.substr("path", F.lit(1), F.lit(longest))
    sites = urls.where("host <> ''").select("host", head.alias("head")).distinct()
    fits = sites.select("host", "head", F.explode(candidates(F.col("host"), F.col("head"), lengths or [0])).alias("site"))
    probes = fits.select("site").distinct().select(
        F.xxhash64("site").alias("digest"), F.lit(True).alias("is_probe"), "site",
        F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("int").alias("host_length"),
        F.lit(None).cast("boolean").alias("listed"))
    keyed = rules.select(F.xxhash64("site").alias("digest"), F.lit(False).alias("is_probe"), "site",
                         "verdict", "host_length", "listed")
    hits = (keyed.union(probes).repartition("digest").sortWithinPartitions("is_probe", "digest")
            .mapInArrow(_probe, "site string, verdict string, host_length int, listed boolean"))
    # A rule goes before a listed site, then length decides.
    rank = F.struct((~F.col("listed")).alias("ruled"), F.length("site").alias("length"), "host_length",
                    (F.col("verdict") == ALLOW).alias("allows"))
    best = (fits.join(hits, "site").groupBy("host", "head")
            .agg(F.max_by(F.struct("site", "verdict", "listed"), rank).alias("best"))
            .select(F.col("host").alias("_host"), F.col("head").alias("_head"), "best"))
    return (urls.join(best, (F.col("host") == F.col("_host")) & (head == F.col("_head")), "left")
            .select("page_id", "host", "path",
                    F.when(~F.col("best.listed"), F.col("best.site")).alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
                    F.coalesce("best.listed", F.lit(False)).alias("listed")))
