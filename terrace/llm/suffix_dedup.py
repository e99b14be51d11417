"""Removal of long repeated byte strings: every byte that a string of ``length`` bytes covers which also begins
anywhere else in the collection goes.

1. *Pieces.*  The starts of a text (positions where ``length`` whole bytes follow) are cut into runs that share an
   anchor: of all short substrings inside the ``length`` bytes the one with the smallest hash, the
   leftmost among equals.  Equal strings have the same anchor at the same offset, so two equal strings always lie
   in pieces with one key (the anchor's hash) and, aligned at the anchor, in the same column.  A piece has
   at most ``2 * length`` bytes; a text of any length is a sequence of them.
2. *Keys.*  Keys that occur once cannot repeat and go.  Where all pieces of a key are one piece over
   and over, the copies are one string with a weight, and all of it repeats.
3. *Layers.*  The different pieces of a key are a collection; ``column_layers`` builds its suffix order column by
   column with common prefixes, and a start repeats if its suffix shares ``length`` bytes with a neighbour in
   its layer.  The collections are read in sequence from a written table sorted by key.
4. *Hot keys.*  More than ``most`` different pieces under a key (a line that a third of all documents hold) are
   cut further: starts are dealt by their offset to the anchor into classes of 16, whose key is the hash of the
   bytes that all strings of the class share (``length - 15`` of them), and, where still needed, into
   single starts, whose key is the whole string.  So no collection outgrows ``most`` and nothing is left out.

The literal form of the construction, one round for every byte of the longest text with the whole transform
rewritten each round, costs the product of the corpus size and the longest text; pieces bound the rounds by ``2 * length``
whatever the texts' lengths.

Keys and digests are 64-bit hashes of different bytes (a piece is known by both), texts are known by 128 bits of
their SHA-256; strings of a collection are compared symbol by symbol.

Defined cases: null text is the empty text; a text below ``length`` bytes is kept whole; every row is a document of its own, so
equal rows, rows with a repeated id and rows without id repeat each other and go whole (if ``length`` bytes long); matches never cross
documents; periodic texts repeat themselves; an empty table gives no rows; further columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.column_layers import batches, repeated_starts, runs
from terrace.llm.common import MARKS, small_batches
from terrace.llm.hashing import U, mix
from terrace.session import materialize

#: Bytes worked on at once; longer texts are taken in stretches that overlap by ``length - 1`` bytes.
STRETCH = 1 << 20
#: Different pieces of one key that one task compares; more are cut further.
MOST = 4096
#: Strings whose layers are built together.
SHEET = 8192
#: Widths of the offset classes that hot keys are cut into.
GRAINS = (16, 1)
_PIECE = "key long, p long, starts array<int>, wins int, lead int"
_RANGES = "array<struct<lo:int,hi:int>>"


def anchor_size(length: int) -> int:
    """The largest power of two within a third of ``length``."""
    return 1 << max((length // 3).bit_length() - 1, 0)


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (a power of two) from each position on, by doubling."""
    h = mix((data.astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
    step = 1
    while step < size:
        h = h[:-step] * U(0xD6E8FEB86659FD93) + h[step:]
        h ^= h >> U(29)
        step *= 2
    return mix(h)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    n = len(values) - width + 1
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, dtype=U)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def stretch_pieces(data: bytes, ends: np.ndarray, length: int):
    """Pieces of texts that stand one after the other in ``data``, each up to its end: (start, starts in it, bytes
    before the anchor, key) as arrays."""
    size = anchor_size(length)
    h = _hashes(np.frombuffer(data, dtype=np.uint8), size)
    at = (h & ~U((1 << 24) - 1)) | np.arange(len(h), dtype=U)
    anchor = (_least(at, length - size + 1) & U((1 << 24) - 1)).astype(np.int64)
    begin = np.concatenate([[0], ends[:-1]])
    whole = np.zeros(len(anchor) + 1, dtype=np.int64)
    has = ends - begin >= length
    np.add.at(whole, begin[has], 1)
    np.add.at(whole, ends[has] - length + 1, -1)
    valid = np.cumsum(whole)[:-1] > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    new[begin[has]] = True
    first = np.flatnonzero(new)
    stop = np.minimum(np.append(first[1:], len(anchor)), ends[np.searchsorted(ends, first, side="right")] - length + 1)
    return first, stop - first, anchor[first] - first, h[anchor[first]].view(np.int64)


def text_pieces(texts: list[bytes], length: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text's number, start, starts in it, bytes before the anchor, key, digest) of every piece of every text."""
    # stretches of about STRETCH bytes: many short texts, or a part of a long one
    held: list[tuple[int, int, bytes]] = []
    total = 0
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        for at in range(0, len(t) - length + 1, STRETCH):
            part = t[at:at + STRETCH + length - 1]
            held.append((i, at, part))
            total += len(part)
            if total >= STRETCH:
                yield from _of_stretch(held, length)
                held, total = [], 0
    if held:
        yield from _of_stretch(held, length)


def _of_stretch(held, length):
    data = b"".join(h[2] for h in held)
    ends = np.cumsum([len(h[2]) for h in held])
    first, wins, lead, key = stretch_pieces(data, ends, length)
    which = np.searchsorted(ends, first, side="right")
    for s, w, d, k, n in zip(first.tolist(), wins.tolist(), lead.tolist(), key.tolist(), which.tolist()):
        i, at, part = held[n]
        yield i, s - int(ends[n]) + len(part) + at, w, d, k, _digest(data[s:s + w - 1 + length])


def _text_key(data: Column) -> list[Column]:
    """Two longs: 128 bits of the text's SHA-256."""
    sha = F.sha2(data, 256)
    return [F.conv(F.substring(sha, a, 16), 16, -10).cast("long").alias(n) for a, n in ((1, "h0"), (17, "h1"))]


def _piece_rows(length: int):
    def rows(frames):
        for f in frames:
            found: dict[tuple, list] = {}
            names = list(zip(f["h0"], f["h1"]))
            seen: set = set()
            texts = [b"" if n in seen or seen.add(n) else bytes(b) for n, b in zip(names, f["data"])]
            copies = f.groupby(["h0", "h1"]).size().to_dict()
            for i, start, wins, lead, key, p in text_pieces(texts, length):
                found.setdefault((i, key, p, wins, lead), []).append(start)
            out = [(*names[i], copies[names[i]], key, p, np.array(s, dtype=np.int32), wins, lead)
                   for (i, key, p, wins, lead), s in found.items()]
            yield pd.DataFrame(out, columns=["h0", "h1", "n", "key", "p", "starts", "wins", "lead"])
    return rows


def _class_rows(length: int, grain: int):
    """Pieces cut into classes of ``grain`` offsets to their anchor; starts are positions in the piece."""
    def rows(frames):
        for f in frames:
            out = []
            for key, p, n, wins, lead, body in zip(f["key"], f["p"], f["n"], f["wins"], f["lead"], f["body"]):
                body = bytes(body)
                for c in range((lead - wins + 1) // grain, lead // grain + 1):
                    far = min(c * grain + grain - 1, lead)
                    near = max(c * grain, lead - wins + 1)
                    lo, some = lead - far, far - near + 1
                    left = lead - c * grain
                    core = body[left:max(left, left - grain + 1 + length)]
                    part = body[lo:lo + some - 1 + length]
                    out.append((key, p, n, _digest(b"%d|%d|%d|" % (grain, c, key) + core), _digest(b"%d|" % far + part),
                                np.array([lo], dtype=np.int32), some, far))
            yield pd.DataFrame(out, columns=["h0", "h1", "n", "key", "p", "starts", "wins", "lead"])
    return rows


def _layer_rows(length: int, most: int):
    def rows(frames):
        def each():
            for f in frames:
                yield from zip(f["key"], f["p"], f["n"], f["lead"], f["body"])

        for batch in batches(each(), most):
            keys = [r[0] for r in batch]
            group = np.cumsum([0] + [a != b for a, b in zip(keys, keys[1:])])
            hit = repeated_starts([bytes(r[4]) for r in batch], np.array([r[3] for r in batch]), group,
                                  np.array([r[2] for r in batch]), length)
            out = [(r[0], r[1], [{"lo": a, "hi": b} for a, b in runs(hit[i])]) for i, r in enumerate(batch) if hit[i].any()]
            yield pd.DataFrame(out, columns=["key", "p", "ranges"])
    return rows


def _resolve(rows: DataFrame, bodies, length: int, most: int, grains: tuple[int, ...]) -> DataFrame:
    """(h0, h1, starts, ranges): of each owner (h0, h1), the starts of its repeated pieces, and which starts of a
    piece, counted from its first, begin a string that occurs elsewhere.

    ``rows``: (h0, h1, n, key, p, starts, wins, lead), n copies of the owner.  ``bodies(wanted)`` gives the bytes of
    owners: (h0, h1, data) for the (h0, h1) in ``wanted``.
    """
    weight = F.size("starts") * F.col("n")
    keys = rows.groupBy("key").agg(F.sum(weight).alias("all"), F.min("p").alias("lo"), F.max("p").alias("hi")) \
        .where("all > 1").select("key", (F.col("lo") != F.col("hi")).alias("mixed"))
    found = materialize(rows.join(keys, "key"), "suffix-found")
    plain = found.where(~F.col("mixed")).select(
        "h0", "h1", "starts", F.array(F.struct(F.lit(0).alias("lo"), (F.col("wins") - 1).alias("hi"))).cast(_RANGES).alias("ranges"))
    mixed = found.where("mixed")
    # one row for each different piece, with the place of one of its occurrences
    different = mixed.groupBy("key", "p").agg(
        F.sum(weight).alias("n"), F.first("h0").alias("h0"), F.first("h1").alias("h1"), F.first(F.col("starts")[0]).alias("at"),
        F.first("wins").alias("wins"), F.first("lead").alias("lead"))
    different = materialize(different, "suffix-different")
    crowd = different.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > most).select("key")
    wanted = different.groupBy("h0", "h1").agg(F.collect_list(F.struct("key", "p", "n", "at", "wins", "lead")).alias("wanted"))
    cut = bodies(wanted.select("h0", "h1")).join(wanted, ["h0", "h1"]).select("data", F.explode("wanted").alias("w")).select(
        "w.key", "w.p", "w.n", "w.wins", "w.lead",
        F.expr(f"substring(data, w.at + 1, w.wins + {length - 1})").alias("body"))
    pieces = materialize(cut, "suffix-pieces")
    hot = materialize(pieces.join(crowd, "key", "left_semi"), "suffix-hot") if grains else None
    small = pieces.join(crowd, "key", "left_anti") if grains else pieces
    layers = small.select("key", "p", "n", "lead", "body").repartition("key").sortWithinPartitions("key") \
        .mapInPandas(_layer_rows(length, SHEET), f"key long, p long, ranges {_RANGES}")
    ranges = layers
    if grains and not hot.isEmpty():
        classes = hot.mapInPandas(_class_rows(length, grains[0]), f"h0 long, h1 long, n long, {_PIECE}")
        inner = _resolve(classes, lambda wanted: hot.select(F.col("key").alias("h0"), F.col("p").alias("h1"), F.col("body").alias("data"))
                         .join(wanted, ["h0", "h1"], "left_semi"), length, most, grains[1:])
        shifted = inner.select(F.col("h0").alias("key"), F.col("h1").alias("p"), F.transform("ranges", lambda r: F.struct(
            (r["lo"] + F.col("starts")[0]).alias("lo"), (r["hi"] + F.col("starts")[0]).alias("hi"))).alias("ranges"))
        ranges = ranges.unionByName(shifted.groupBy("key", "p").agg(F.flatten(F.collect_list("ranges")).alias("ranges")))
    return plain.unionByName(mixed.join(ranges, ["key", "p"]).select("h0", "h1", "starts", "ranges"))


def _kept_rows(length: int):
    def rows(frames):
        for f in frames:
            out = []
            for h0, h1, data, lo, hi in zip(f["h0"], f["h1"], f["data"], f["lo"], f["hi"]):
                data = np.frombuffer(bytes(data), dtype=np.uint8)
                step = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(step, np.asarray(lo), 1)
                np.add.at(step, np.asarray(hi), -1)
                gone = np.cumsum(step)[:-1] > 0
                spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                out.append((h0, h1, int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            yield pd.DataFrame(out, columns=["h0", "h1", "n_removed", "n_spans", "kept_sha256"])
    return rows


def _marked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``texts`` that may be wanted: keys are dealt into MARKS numbers and those in use, MARKS at most, are
    broadcast; an exact join follows, so that few texts are shuffled while few are wanted."""
    mark = F.pmod(F.col("h0"), F.lit(MARKS)).alias("mark")
    used = F.broadcast(wanted.select(mark).distinct())
    return texts.withColumn("mark", mark).join(used, "mark", "left_semi").drop("mark")


def _spans(docs: DataFrame, length: int, most: int):
    """(texts, copies, cover): long texts by (h0, h1); those that occur more than once; for the other texts what
    is to be removed, as ``lo`` and ``hi`` arrays of stretches that may overlap."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    texts = docs.select(data.alias("data")).where(F.octet_length("data") >= length).select(*_text_key(F.col("data")), "data")
    copies = texts.groupBy("h0", "h1").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h0", "h1")
    seen = materialize(texts.mapInPandas(_piece_rows(length), f"h0 long, h1 long, n long, {_PIECE}"), "suffix-seen")

    def bodies(wanted):
        # one row a text: copies meet in a partial aggregation
        return _marked(texts, wanted).join(wanted, ["h0", "h1"], "left_semi").groupBy("h0", "h1").agg(F.first("data").alias("data"))

    found = _resolve(seen, bodies, length, most, GRAINS)
    cover = found.join(copies, ["h0", "h1"], "left_anti").select("h0", "h1", F.flatten(F.transform(
        "starts", lambda s: F.transform("ranges", lambda r: F.struct(
            (s + r["lo"]).alias("lo"), (s + r["hi"] + length).alias("hi"))))).alias("r"))
    cover = cover.groupBy("h0", "h1").agg(F.flatten(F.collect_list("r")).alias("r")) \
        .select("h0", "h1", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))
    return texts, copies, cover


def dedup(docs: DataFrame, length: int = 400, most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    texts, copies, cover = _spans(small_batches(docs), length, most)
    cover = materialize(cover, "suffix-cover")
    part = _marked(texts, cover).join(cover, ["h0", "h1"]).mapInPandas(
        _kept_rows(length), "h0 long, h1 long, n_removed long, n_spans long, kept_sha256 string")
    gone = copies.select("h0", "h1", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                         F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"))
    touched = materialize(part.unionByName(gone), "suffix-touched")
    data = F.coalesce("text", F.lit("")).cast("binary")
    every = docs.select("doc_id", F.octet_length(data).cast("long").alias("n_bytes"), F.sha2(data, 256).alias("whole"), *_text_key(data))
    return every.join(touched, ["h0", "h1"], "left").select(
        "doc_id", "n_bytes",
        F.when(F.col("kept_sha256").isNull(), F.lit(0)).otherwise(F.coalesce("n_removed", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
