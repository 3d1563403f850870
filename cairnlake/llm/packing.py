"""Items into containers of fixed capacity by minimum bin slack.

An item that exceeds the capacity is cut into full pieces, each a container of
its own, and a rest; nothing else is ever cut. Per container the largest item
left is the seed; a bitset subset-sum over the lengths left, longest first,
finds the fullest feasible combination to go with it (it stops as soon as the
container can be full), which is taken back from the bitsets and removed.

Items are spread over blocks of about ``BLOCK`` items by a hash of their id,
so a block is bounded at any corpus size and blocks run in parallel; each
block leaves at most its last container badly filled. Within a block items of
one length are interchangeable, so the bitsets run over distinct lengths.

Odd cases: an item without tokens (empty or null text) takes a place of length
0 in its block's first container; repeated ids are separate items, told apart by
a copy number; a null or non-positive capacity gives no containers; an empty
corpus an empty result.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items of a block, on average.
BLOCK = 4096


def fullest(room: int, lengths: list[int], counts: dict[int, int]) -> list[int]:
    """The lengths, out of ``lengths`` (descending, with ``counts``), whose sum is the largest up to ``room``."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in lengths:
        if n > room or n == 0:
            continue
        for _ in range(min(counts[n], room // n)):
            new = reach | (reach << n) & mask
            if new == reach:
                break
            steps.append((n, reach))
            reach = new
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        if not before >> at & 1:  # only reached with this item
            chosen.append(n)
            at -= n
    return chosen


def pack(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Containers of (item, first token, tokens) for items of the given sizes."""
    full: list[list[tuple[int, int, int]]] = []
    rest: dict[int, list[tuple[int, int]]] = {}
    empty: list[int] = []
    for item, n in enumerate(sizes):
        at = 0
        while n - at > capacity or n - at == capacity:
            full.append([(item, at, capacity)])
            at += capacity
        if n - at or n == 0:
            (rest.setdefault(n - at, []).append((item, at)) if n - at else empty.append(item))
    counts = {n: len(v) for n, v in rest.items()}
    lengths = sorted(counts, reverse=True)
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        chosen = [seed, *fullest(capacity - seed, lengths, counts)]
        for n in chosen[1:]:
            counts[n] -= 1
        full.append([(*rest[n].pop(), n) for n in chosen])
        lengths = [n for n in lengths if counts[n]] if any(not counts[n] for n in chosen) else lengths
    if empty:
        (full or full.append([]) or full)[0].extend((i, 0, 0) for i in empty)
    return full


def packed(sizes: DataFrame, budgets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pieces of every item under every budget: one row for each piece.

    ``sizes`` has doc_id, tokenizer, n_tokens; ``budgets`` (a fixed, tiny table
    whose rows are read by the driver) budget_name, tokenizer, capacity_tokens.
    """
    wanted = [(r[0], r[1], int(r[2])) for r in budgets.select("budget_name", "tokenizer", "capacity_tokens").collect() if r[2] is not None and r[2] > 0]
    n = sizes.groupBy("tokenizer").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-n // block))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        own, number = pdf["tokenizer"].iloc[0], int(pdf["block"].iloc[0])
        pdf = pdf.sort_values(["doc_id", "n_tokens"], kind="stable", na_position="first")
        for lo in range(0, len(pdf), 4 * block):  # a block swollen by repeated ids is cut again
            part = pdf.iloc[lo : lo + 4 * block]
            ids, copies = part["doc_id"].to_list(), part.groupby("doc_id", dropna=False).cumcount().to_list()
            for name, tokenizer, capacity in wanted:
                if tokenizer != own:
                    continue
                for k, pieces in enumerate(pack(part["n_tokens"].astype("int64").to_list(), capacity)):
                    out += [(name, capacity, f"{number}-{lo // (4 * block)}-{k}", ids[i], copies[i], a, m) for i, a, m in pieces]
        return pd.DataFrame(out, columns=["budget_name", "capacity_tokens", "container", "doc_id", "copy", "first_token", "n_tokens"]).astype({"doc_id": "Int64"})

    schema = "budget_name string, capacity_tokens bigint, container string, doc_id bigint, copy bigint, first_token bigint, n_tokens bigint"
    # A fixed number of partitions: the rows are few but their work isn't, so they must not be coalesced by size.
    tasks = max(1, min(blocks, int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    spread = sizes.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).repartition(tasks, "tokenizer", "block")
    return spread.groupBy("tokenizer", "block").applyInPandas(run, schema)
