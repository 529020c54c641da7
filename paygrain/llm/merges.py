"""Pair merging with a hierarchical-bitmap rank queue, for every byte-pair vocabulary used here."""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping
from heapq import heappop, heappush

class Merger:
    """Merges symbol ids pair by pair, lowest rank first, leftmost first among equal ranks.

    ``pairs`` maps ``left << 32 | right`` to a rank, ``made`` maps a rank to the id it makes.

    The queue is a hierarchical bitmap over ranks: ``groups`` has a bit for every 256 ranks of which any is
    waiting, ``bits`` the ranks of each such group. The lowest set bit of either names the next rank; its
    bucket, a heap, names the leftmost position. Positions form a linked list. A bucket entry whose pair has
    changed since is stale and skipped. A merge costs the logarithm of a bucket's size, whatever the length.
    """

    def __init__(self, pairs: Mapping[int, int], made: Mapping[int, int] | list[int]) -> None:
        self.pairs, self.made = pairs, made

    def merge(self, ids: list[int]) -> list[int]:
        get, made = self.pairs.get, self.made
        rank_at = [get(a << 32 | b) for a, b in zip(ids, ids[1:], strict=False)]
        groups = 0
        bits: dict[int, int] = {}
        buckets: dict[int, list[int]] = {}
        for i, rank in enumerate(rank_at):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    group = rank >> 8
                    bits[group] = bits.get(group, 0) | 1 << (rank & 255)
                    groups |= 1 << group
        if not groups:
            return ids
        ids, n = list(ids), len(ids)
        rank_at.append(None)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while groups:
            group = (groups & -groups).bit_length() - 1
            waiting = bits[group]
            rank = group << 8 | (waiting & -waiting).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                waiting = bits[group] = waiting & (waiting - 1)
                if not waiting:
                    groups &= groups - 1
            if rank_at[i] != rank:
                continue
            j = after[i]
            merged = ids[i] = made[rank]
            ids[j] = -1
            rank_at[j] = None
            k = after[i] = after[j]
            h = before[i]
            if k < n:
                before[k] = i
                right = rank_at[i] = get(merged << 32 | ids[k])
            else:
                right = rank_at[i] = None
            if h >= 0:
                left = rank_at[h] = get(ids[h] << 32 | merged)
            else:
                left = None
            if right is not None:
                if right in buckets:
                    heappush(buckets[right], i)
                else:
                    buckets[right] = [i]
                    group = right >> 8
                    bits[group] = bits.get(group, 0) | 1 << (right & 255)
                    groups |= 1 << group
            if left is not None:
                if left in buckets:
                    heappush(buckets[left], h)
                else:
                    buckets[left] = [h]
                    group = left >> 8
                    bits[group] = bits.get(group, 0) | 1 << (left & 255)
                    groups |= 1 << group
        return [x for x in ids if x >= 0]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merger_of_ranks(ranks: dict[bytes, int]) -> Merger:
    """For rank files: any two neighbours whose bytes together are a token may merge, at that token's rank."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    return Merger(pairs, range(max(ranks.values(), default=0) + 1))


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies (a fixed rule of the format)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + n) for n, b in enumerate(hidden)})
    return [letters[b] for b in range(256)]


def read_vocabulary(path: str) -> tuple[dict[str, int], list[tuple[str, str]], dict[str, int], str]:
    """Tokens, merges, special tokens and word-end suffix of a tokenizer file of type BPE."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    model = content["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    return model["vocab"], merges, special, model["end_of_word_suffix"] or ""


def merger_of_merges(vocab: dict[str, int], merges: list[tuple[str, str]]) -> Merger:
    """For tokenizer files: only the listed pairs merge, in their order."""
    pairs = {vocab[a] << 32 | vocab[b]: n for n, (a, b) in enumerate(merges)}
    return Merger(pairs, [vocab[a + b] for a, b in merges])
