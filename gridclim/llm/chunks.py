"""Media columns: payloads stored as content-defined chunks.

A payload is wrapped as 8-bit mono WAV; the WAV, header and all, is what is stored. It is cut where a rolling gear hash of the last
32 bytes has its upper bits clear. A medium is cut once: the recipe, its chunks' digests and lengths in order, is kept under the
medium's own digest. Spark joins on chunk digests choose one owner for each chunk (the smallest doc_id, then medium, then place);
the store keeps a row per document: its recipe, the digest of the whole and, compressed, the chunks that it owns. Reading back takes
own chunks from the row and fetches the borrowed ones by digest, in recipe order; every chunk and the whole are verified by their
digests, and the samples are found by parsing the WAV that was put together. Short media compress better with a book, a dictionary
learnt from a bounded sample, which is kept beside the store.

Defined results: a null or empty text is 64 zero bytes; equal texts give equal media; rows that share a doc_id are stored
and read each for itself; rows with a null doc_id never lend or borrow; an empty table gives an empty table; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.llm.common import map_texts, stage

PAD = 64
SPAN = 32
#: A cut needs so many upper bits clear: 2048 bytes apart on average, within the bounds.
CLEAR_BITS, LEAST, MOST = 11, 512, 16_384
#: A store's book has so many bytes, learnt from so many texts.
BOOK_BYTES, BOOK_TEXTS, LEVEL = 112 << 10, 1_000, 14
GEAR = np.random.Generator(np.random.PCG64(8)).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def payload_of(text: str) -> bytes:
    """The text's UTF-8 bytes, closed by zero bytes up to a positive multiple of 64."""
    raw = text.encode()
    return raw + bytes(-len(raw) % PAD if raw else PAD)


def wav(samples: bytes) -> bytes:
    """8-bit mono WAV, 8 kHz."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples), b"WAVE", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8, b"data", len(samples))
    return head + samples


def samples_of(media: bytes) -> bytes:
    """The samples of 8-bit mono WAV: the RIFF chunks are walked through to the data."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE" or struct.unpack_from("<I", media, 4)[0] != len(media) - 8:
        raise ValueError("no whole WAV")
    at, plain = 12, False
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            form, channels, _, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            plain = (form, channels, bits) == (1, 1, 8)
        if name == b"data":
            if not plain or at + 8 + size > len(media):
                raise ValueError("no 8-bit mono samples")
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAV without samples")


def cuts(payload: bytes) -> list[int]:
    """Ends of the payload's chunks."""
    h = GEAR[np.frombuffer(payload, np.uint8)]
    width = 1
    while width < SPAN:  # a hash of twice the width is the later half plus the earlier half moved up
        h = h + np.concatenate([np.zeros(min(width, len(h)), np.uint32), h[:-width] << np.uint32(width)])
        width *= 2
    ends, last = [], 0
    for at in (np.flatnonzero(h >> np.uint32(32 - CLEAR_BITS) == 0) + 1).tolist():
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST:
            ends.append(last := at)
    while len(payload) - last > MOST:
        ends.append(last := last + MOST)
    return ends if last == len(payload) else [*ends, len(payload)]


def _split(payload: bytes) -> list[bytes]:
    ends = cuts(payload)
    return [payload[a:b] for a, b in zip([0, *ends], ends)]


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


@lru_cache(maxsize=2)
def _codec(book: bytes) -> tuple:
    """Compressor and decompressor that know the book; an empty one says only what a WAV's header looks like."""
    known = zstandard.ZstdCompressionDict(book) if book else zstandard.ZstdCompressionDict(wav(b""), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known), zstandard.ZstdDecompressor(dict_data=known)


def _mark(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _squeeze(data: bytes, book: bytes) -> bytes:
    return _codec(book)[0].compress(data)


def unpack(data: bytes, book: bytes = b"") -> bytes:
    """The bytes of a store's `own`."""
    return _codec(book)[1].decompress(data)


def learn_book(docs: DataFrame) -> bytes:
    """docs(text) -> a dictionary for compressing short media, learnt from a chunk of each of the BOOK_TEXTS different texts of smallest
    hash (at most 16 MB); empty where that is too little to learn from. Only the stored size depends on it."""
    hashed = docs.where(F.length("text") > 0).select(F.xxhash64("text").alias("h"), "text")
    least = [r.h for r in hashed.select("h").distinct().orderBy("h").limit(BOOK_TEXTS).collect()]

    def pick(batch: list[str]) -> list:
        return [[min(_split(wav(payload_of(t))), key=_digest) for t in batch]]

    chosen = map_texts(hashed.where(F.col("h") <= max(least, default=0)), pick, {"chunk": "binary"}).groupBy("h").agg(F.first("chunk").alias("chunk"))
    try:
        return zstandard.train_dictionary(BOOK_BYTES, [bytes(r.chunk) for r in sorted(chosen.collect(), key=lambda r: r.h)]).as_bytes()
    except zstandard.ZstdError:  # too few or too short chunks
        return b""


def _recipe(digests: list[bytes], lengths: list[int]) -> bytes:
    """A recipe: 16 bytes of digest and 2 of length for each chunk."""
    return b"".join(d + struct.pack("<H", n) for d, n in zip(digests, lengths))


def _read_recipe(recipe: bytes) -> list[tuple[bytes, int]]:
    return [(recipe[i : i + 16], struct.unpack_from("<H", recipe, i + 16)[0]) for i in range(0, len(recipe), 18)]


def store(docs: DataFrame, book: bytes = b"") -> DataFrame:
    """docs(doc_id, text) -> the chunk store, written: doc_id, n_bytes, whole (the medium's digest), recipe, own (compressed), lent,
    borrowed (digests of own chunks that others use, and of chunks that others own). What was stored by a book is read by it."""
    docs = docs.select("doc_id", "text")

    def plan(batch: list[str]) -> list:
        marks, wholes, recipes = [], [], []
        for text in batch:
            media = wav(payload_of(text))
            chunks = _split(media)
            wholes.append(_digest(media))
            marks.append(_mark(wholes[-1]))
            recipes.append(_recipe([_digest(c) for c in chunks], [len(c) for c in chunks]))
        return [marks, wholes, recipes]

    plans, _ = stage(map_texts(docs.where(F.col("doc_id").isNotNull()), plan, {"mark": "long", "whole": "binary", "recipe": "binary"}), "recipes")

    def digests_of(recipes: list[bytes]) -> tuple:
        listed = [_read_recipe(r) for r in recipes]
        return np.repeat(np.arange(len(listed)), [len(x) for x in listed]), [[d for x in listed for d, _ in x], [k for x in listed for k in range(len(x))]]

    row = ["doc_id", "mark"]  # a row is known by its id and the beginning of its medium's digest, as ids may repeat
    uses = map_texts(plans.select(*row, "recipe"), digests_of, {"digest": "binary", "seq": "int"}, "recipe")
    place = F.struct(*row, "seq")
    used = uses.groupBy("digest").agg(F.min(place).alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1")
    used, _ = stage(used.select("digest", "owner"), "shared-chunks")
    mine = (F.col("owner.doc_id") == F.col("doc_id")) & (F.col("owner.mark") == F.col("mark"))
    shared = uses.join(used, "digest").groupBy(*row).agg(
        F.collect_set(F.when(mine & (F.col("owner.seq") == F.col("seq")), F.col("digest"))).alias("lent"),
        F.collect_set(F.when(~mine, F.col("digest"))).alias("borrowed"),
    )
    known = plans.groupBy(*row).agg(F.first(F.struct("whole", "recipe")).alias("plan")).join(shared, row, "left")  # equal rows have one plan

    def squeezed(batch: list[str]) -> list:
        media = [wav(payload_of(t)) for t in batch]
        return [[len(t.encode()) for t in batch], [_mark(_digest(m)) for m in media], [_squeeze(m, book) for m in media]]

    packed = map_texts(docs.where(F.col("doc_id").isNotNull()), squeezed, {"n_bytes": "long", "mark": "long", "media": "binary"}).join(known, row)
    packed = packed.select("doc_id", "n_bytes", "media", "plan.whole", "plan.recipe", "lent", "borrowed")

    def alone(batch: list[str]) -> list:
        """Rows without an id share nothing: they are planned and kept at once."""
        _, wholes, recipes = plan(batch)
        return [[len(t.encode()) for t in batch], [_squeeze(wav(payload_of(t)), book) for t in batch], wholes, recipes]

    none = map_texts(docs.where(F.col("doc_id").isNull()), alone, {"n_bytes": "long", "media": "binary", "whole": "binary", "recipe": "binary"})
    packed = packed.unionByName(none, allowMissingColumns=True)

    def keep_own(media: list[bytes], recipes: list, borrowed: list) -> list:
        owns = []
        for data, recipe, away in zip(media, recipes, borrowed):
            parts, taken, raw, at = [], {bytes(x) for x in away or ()}, None, 0
            listed = _read_recipe(recipe)
            if not taken and len({d for d, _ in listed}) == len(listed):
                owns.append(data)  # all chunks are its own, each once: as it is
                continue
            raw = unpack(data, book)
            for digest, length in listed:
                if digest not in taken:
                    taken.add(digest)  # a chunk that the document repeats is kept once
                    parts.append(raw[at : at + length])
                at += length
            owns.append(_squeeze(b"".join(parts), book))
        return [owns]

    packed = packed.withColumns({"_recipe": F.col("recipe"), "_borrowed": F.col("borrowed")})
    done = map_texts(packed, keep_own, {"own": "binary"}, "media", ("_recipe", "_borrowed"))
    empty = F.array().cast("array<binary>")
    done = done.select("doc_id", "n_bytes", "whole", "recipe", "own", *(F.coalesce(c, empty).alias(c) for c in ("lent", "borrowed")))
    return stage(done, "chunk-store")[0]


def _own_chunks(recipe: bytes, own: bytes, borrowed: set[bytes], book: bytes) -> dict[bytes, bytes]:
    data, at, found = unpack(own, book), 0, {}
    for digest, length in _read_recipe(recipe):
        if digest not in borrowed and digest not in found:
            found[digest] = data[at : at + length]
            at += length
    return found


def _rebuild(doc_id: object, whole: bytes, recipe: bytes, own: bytes, borrowed: list, fetched: list, book: bytes) -> bytes:
    """The medium of a recipe, from own and fetched chunks; each chunk and the whole are verified."""
    chunks = _own_chunks(recipe, own, {bytes(x) for x in borrowed}, book)
    chunks |= {bytes(x["digest"]): unpack(bytes(x["chunk"]), book) for x in fetched or ()}
    parts = []
    for digest, length in _read_recipe(recipe):
        if digest not in chunks:
            raise ValueError(f"the store lacks chunk {digest.hex()} of document {doc_id}")
        chunk = chunks[digest]
        if len(chunk) != length or _digest(chunk) != digest:
            raise ValueError("a stored chunk is damaged")
        parts.append(chunk)
    media = b"".join(parts)
    if _digest(media) != whole:
        raise ValueError("a stored medium is damaged")
    return media


def features(samples: bytes) -> str:
    """Level and zero crossings of the samples around their middle value, and their entropy in bits."""
    x = np.frombuffer(samples, np.uint8)
    high = x >= 128
    share = np.bincount(x, minlength=256) / len(x)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    rms = np.sqrt(np.square(x.astype(np.float64) - 128).mean())
    return f"rms={rms:.4f};crossings={np.count_nonzero(high[1:] != high[:-1])};entropy={entropy:.4f}"


def read(stored: DataFrame, book: bytes = b"") -> DataFrame:
    """The stored media, verified and described: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32,
    media_bytes, media_sha256, feature."""
    def lend(owns: list[bytes], recipes: list, lents: list, borrowed: list) -> tuple:
        at, digests, chunks = [], [], []
        for i, (own, recipe, lent, away) in enumerate(zip(owns, recipes, lents, borrowed)):
            found = _own_chunks(recipe, own, {bytes(x) for x in away}, book)
            for digest in {bytes(x) for x in lent} & found.keys():
                at.append(i)
                digests.append(digest)
                chunks.append(_squeeze(found[digest], book))
        return at, [digests, chunks]

    inputs = ("recipe", "lent", "borrowed")
    lenders = stored.where(F.size("lent") > 0).select("own", *inputs)
    lent = map_texts(lenders, lend, {"digest": "binary", "chunk": "binary"}, "own", inputs)
    borrowers = stored.where(F.size("borrowed") > 0)
    wanted = borrowers.select("doc_id", "whole", F.explode("borrowed").alias("digest"))
    # rows that are there twice lend twice, and are made one again here: a step before the join would keep Spark from splitting hot chunks
    fetched = wanted.join(lent, "digest").groupBy("doc_id", "whole").agg(F.collect_set(F.struct("digest", "chunk")).alias("fetched"))

    def describe(owns: list[bytes], ids: list, wholes: list, recipes: list, borrowed: list, got: list) -> list:
        rows = []
        for own, doc_id, whole, recipe, away, extra in zip(owns, ids, wholes, recipes, borrowed, got):
            media = _rebuild(doc_id, whole, recipe, own, away, extra, book)
            samples = samples_of(media)
            rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-PAD:]), len(media), hashlib.sha256(media).hexdigest(), features(samples)))
        return list(zip(*rows))

    added = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}
    none = F.lit(None).cast("array<struct<digest: binary, chunk: binary>>").alias("fetched")
    columns = ["doc_id", F.col("doc_id").alias("_id"), "n_bytes", "whole", "recipe", "own", "borrowed"]
    inputs = ("_id", "whole", "recipe", "borrowed", "fetched")
    alone = map_texts(stored.where(F.size("borrowed") == 0).select(*columns, none), describe, added, "own", inputs)
    # a medium whose lender is lost is an error, no row less
    joined = map_texts(borrowers.select(*columns).join(fetched, ["doc_id", "whole"], "left"), describe, added, "own", inputs)
    return alone.unionByName(joined)
