"""Discovery runs: slugs from the URL index or from aggregator redirects."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from hirelake.operators import discovery
from hirelake.operators.blocks import find_blocks
from hirelake.session import materialize
from hirelake.sources.boards import REGISTRY, host_patterns
from hirelake.sources.slug_lists import write_slug_table, write_snapshot
from hirelake.sources.url_index import in_blocks, slugs_in_records

INDEX_SOURCE = "cc"
AGGREGATOR_SOURCE = "simplify"


@dataclass(frozen=True)
class DiscoveryResult:
    found: DataFrame    # ats, slug
    merged: DataFrame   # ats, slug, is_new
    counts: DataFrame   # ats, new_count, total


def _merge_and_save(found: DataFrame, existing: DataFrame, source: str,
                    slugs_out: str, snapshot_out: str) -> DiscoveryResult:
    # The distinct slugs are small beside what they were found in; three consumers.
    found = materialize(found, f"found-{source}")
    merged = materialize(discovery.merge_slugs(existing, found), f"merged-{source}")
    write_slug_table(merged, slugs_out)
    write_snapshot(found, source, snapshot_out)
    return DiscoveryResult(found, merged, discovery.merge_counts(merged))


def discover_from_index(records: DataFrame, existing: DataFrame, slugs_out: str,
                        snapshot_out: str) -> DiscoveryResult:
    """Slugs in landed index records, merged with the existing ones.

    slugs_out must not be the path `existing` is read from.
    """
    return _merge_and_save(slugs_in_records(records), existing, INDEX_SOURCE,
                           slugs_out, snapshot_out)


def discover_from_blocks(index: DataFrame, records: DataFrame, prefixes: Mapping[str, Sequence[str]],
                         existing: DataFrame, slugs_out: str, snapshot_out: str,
                         only: Iterable[str] | None = None) -> DiscoveryResult:
    """Slugs in the index blocks that may hold a system's keys, merged with the existing ones.

    index: block lines as of url_index.parse_block_lines; records: (shard, offset, line), best landed
    by shard; prefixes: the key prefixes of each system; only: the systems to look for (all of
    prefixes by default). Records of other blocks are not read.
    """
    names = list(prefixes if only is None else only)
    wanted = [p for n in names for p in prefixes[n]]
    blocks = materialize(find_blocks(index, wanted), "blocks")
    found = slugs_in_records(in_blocks(records, blocks), [REGISTRY[n] for n in names])
    return _merge_and_save(found, existing, INDEX_SOURCE, slugs_out, snapshot_out)


def discover_from_aggregator(postings: DataFrame, redirects: DataFrame, existing: DataFrame,
                             slugs_out: str, snapshot_out: str,
                             patterns: Mapping[str, str] | None = None) -> DiscoveryResult:
    """Slugs behind one posting per company of an aggregator.

    slugs_out must not be the path `existing` is read from.
    """
    one_each = discovery.first_hits(postings, "company_id", ["hit_rank", "posting_id"])
    found = discovery.resolve_redirects(one_each, redirects, patterns or host_patterns())
    return _merge_and_save(found, existing, AGGREGATOR_SOURCE, slugs_out, snapshot_out)
