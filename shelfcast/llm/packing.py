"""Packing documents into token sequences by lexical retrieval.

Documents are tokenised once, and BM25's statistics (document frequencies, number of documents,
mean length) are those of the whole table. A sort key of weighted minimum hashes brings documents
that share rare terms next to each other, wherever they were, and the order of the keys is cut
into shards of a bounded size: a large group of one first hash is cut by the next ones. A task
builds an inverted index of its shard and fills windows: a seed document comes first, then the
unused documents that score highest against the part of the seed in this window. Whatever does
not fit is cut and is the seed of the next window, so windows have no padding; the last tokens of
a shard are laid out in sequences whose lengths are powers of two.

A seed asks its own shard only. Two documents share a first hash with the probability of their
weighted Jaccard index, so neighbours that share little may still lie in different shards.
"""

import json
import zlib
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.arrow import batch_of, texts_of
from shelfcast.llm.token_count import WORDS, byte_symbols, local_name
from shelfcast.session import cut_lineage

#: BM25's saturation and length weights.
K1, B = 1.2, 0.75
#: What a document counts for besides its bytes when shards are sized.
ROW_BYTES = 256
#: Minimum hashes in a document's sort key, their seed, and sampled keys for each shard.
HASHES, SEED, SAMPLED = 8, 11, 32
#: Shards that meet in a task.
SHARDS_A_TASK = 16
#: Weights are multiples of this, so that sums do not depend on their order.
_GRAIN = 2.0**-30


@lru_cache(maxsize=1)
def _encoder(path):
    """The vocabulary file as a fast encoder; its merges must be ranked by their ids."""
    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    vocab, merges = stated["model"]["vocab"], stated["model"]["merges"]
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    if made != sorted(made):
        raise ValueError("the ids of this vocabulary do not follow the order of its merges")
    special = {t["content"]: t["id"] for t in stated["added_tokens"]}
    byte_of = {c: b for b, c in byte_symbols().items()}
    ranks = {bytes(byte_of[c] for c in s): i for s, i in vocab.items() if s not in special}
    return tiktoken.Encoding("given", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


def distinct_terms(ids):
    """(document, term, count) arrays of all documents at once, by document and term."""
    sizes = np.array([len(x) for x in ids])
    key = np.repeat(np.arange(len(ids), dtype=np.int64) << 32, sizes)
    key |= np.concatenate(ids) if len(ids) else np.zeros(0, dtype=np.int64)
    key.sort()
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(key)))
    key = key[starts]
    return key >> 32, key & (2**32 - 1), counts


def slices(batch, rows=512):
    """The batch in slices of so many rows: what Python makes of a slice is gone before the next."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _id_chunks(batch, most_ids=250_000):
    """Id arrays of a batch, in slices with a bounded number of ids (one document at least)."""
    held, size = [], 0
    for part in slices(batch):
        for x in part.column("__ids").to_pylist():
            held.append(np.frombuffer(x, dtype="<u4"))
            size += len(held[-1])
            if size >= most_ids:
                yield held
                held, size = [], 0
    if held:
        yield held


def _rarity(held, documents):
    return np.log1p((documents - held + 0.5) / (held + 0.5))


class InvertedIndex:
    """BM25 postings of one shard, sorted by term.

    `corpus` is (documents that hold each term, documents, mean length) of the whole table, by
    default those of `ids`. Terms that more than `most_common` of the documents hold are rows of
    a matrix instead of postings; they count like any other.
    """

    def __init__(self, ids, most_common=0.25, corpus=None):
        self.documents = len(ids)
        owner, terms, counts = distinct_terms(ids)
        here = np.bincount(terms)
        lengths = np.array([len(x) for x in ids], dtype=np.float64)
        held, documents, mean = corpus or (here, len(ids), lengths.mean())
        norm = K1 * (1 - B + B * lengths / mean)
        weight = _rarity(held[terms], documents) * counts * (K1 + 1) / (counts + norm[owner])
        weight = np.round(weight / _GRAIN) * _GRAIN
        common = np.flatnonzero(here > max(2, most_common * len(ids)))
        self.row = np.full(len(here), -1)
        self.row[common] = np.arange(len(common))
        dense = self.row[terms] >= 0
        self.common = np.zeros((len(common), len(ids)))
        self.common[self.row[terms[dense]], owner[dense]] = weight[dense]
        order = np.flatnonzero(~dense)[np.argsort(terms[~dense], kind="stable")]
        self.owner, self.weight = owner[order], weight[order]
        self.ends = np.cumsum(np.bincount(terms[order], minlength=len(here)))

    def scores(self, query):
        """BM25 score of every document for the distinct terms of `query`."""
        terms = np.unique(query)
        terms = terms[terms < len(self.ends)]
        ends = self.ends[terms]
        starts = np.where(terms > 0, self.ends[np.maximum(terms, 1) - 1], 0)
        sizes = ends - starts
        before = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(starts - before, sizes)
        asked = np.zeros(len(self.common))
        asked[self.row[terms][self.row[terms] >= 0]] = 1
        return np.bincount(self.owner[at], weights=self.weight[at], minlength=self.documents) + asked @ self.common


def fill_windows(ids, window=1024, most_common=0.25, corpus=None):
    """Pieces (document, start, length, sequence, offset) that lay out every id once.

    `ids` are the documents' id arrays, none of them empty; `corpus` see InvertedIndex. Seeds that no unused document
    shares a term with are followed by the first unused one; equal scores go to the first.
    """
    if not ids:
        return []
    index = InvertedIndex(ids, most_common, corpus)
    unused = np.ones(len(ids), dtype=bool)
    sequences, first, rest = [], 0, None
    left = len(ids)
    while left or rest:
        pieces, room = [], window
        if rest:
            doc, start = rest
        else:
            while not unused[first]:
                first += 1
            doc, start = first, 0
            unused[doc] = False
            left -= 1
        rest, ranking = None, None
        while True:
            take = min(len(ids[doc]) - start, room)
            pieces.append((doc, start, take, window - room))
            room -= take
            if start + take < len(ids[doc]):
                rest = (doc, start + take)
            if not room or not left:
                break
            if ranking is None:
                seed, at, size, _ = pieces[0]
                ranking = index.scores(ids[seed][at:at + size])
                ranking[~unused] = -1
            doc, start = int(ranking.argmax()), 0
            ranking[doc] = -1
            unused[doc] = False
            left -= 1
        sequences.append(pieces)
    laid = [(doc, start, take, n, offset) for n, pieces in enumerate(sequences[:-1]) for doc, start, take, offset in pieces]
    return laid + _by_powers(sequences[-1], len(sequences) - 1)


def _by_powers(pieces, sequence):
    """The last window cut at powers of two, the largest first."""
    total = sum(p[2] for p in pieces)
    room, offset, out = 1 << (total.bit_length() - 1), 0, []
    for doc, start, take, _ in pieces:
        while take:
            part = min(take, room - offset)
            out.append((doc, start, part, sequence, offset))
            start, take, offset, total = start + part, take - part, offset + part, total - part
            if offset == room and total:
                room, offset, sequence = 1 << (total.bit_length() - 1), 0, sequence + 1
    return out


def _statistics(encoded):
    """(documents that hold each term, documents, mean length) of all encoded documents.

    There are as many frequencies as the vocabulary has ids, whatever the number of documents.
    """
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def count(batches):
        held = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in _id_chunks(batch):
                here = np.bincount(distinct_terms(ids)[1], minlength=len(held))
                here[:len(held)] += held
                held = here
        found = np.flatnonzero(held)
        yield batch_of(schema, found, held[found])

    rows = encoded.select("__ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    documents, mean = encoded.agg(F.count(F.lit(1)), F.avg("__tokens")).first()
    held = np.zeros(max((r.term for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        held[r.term] = r.n
    return held, documents, mean


def _hash_table(corpus):
    """A row for each hash: the value of every term, small more often for rare ones.

    Terms of a single document are never the smallest, as nothing else can share them.
    """
    held, documents, _ = corpus
    drawn = np.random.default_rng(SEED).exponential(size=(HASHES, len(held)))
    return np.where(held > 1, drawn / np.maximum(_rarity(held, documents), 1e-300) ** 2, np.inf)


def near_keys(ids, table):
    """Sort keys of documents: the term of each minimum hash; documents close in them share rare terms."""
    owner, terms, _ = distinct_terms(ids)
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    out = np.empty((len(ids), len(table)), dtype=">u4")
    for i, values in enumerate(table):
        own = values[terms]
        least = np.minimum.reduceat(own, first)
        hits = np.flatnonzero(own == least[owner])
        hits = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])]
        out[:, i] = np.where(np.isfinite(least), terms[hits], 2**32 - 1)
    return [row.tobytes() for row in out]


def _bounds(rows, corpus, shards, total):
    """Keys at which the order of all documents is cut into shards of about equal size.

    They come from about SAMPLED documents a shard, picked by hash in proportion to their size.
    """
    if shards < 2:
        return []
    rate = shards * SAMPLED / total
    picked = rows.where(
        F.pmod(F.xxhash64("__row", "__hash"), F.lit(2**30)) < F.col("__bytes") * F.lit(rate * 2**30)
    ).select("__ids", "__hash", "__row", "__bytes")
    schema = pa.schema([("key", pa.binary()), ("weight", pa.float64())])

    def keys(batches):
        table = _hash_table(corpus)
        for batch in batches:
            weights = np.maximum(1.0, batch.column("__bytes").to_numpy() * rate)
            yield batch_of(schema, _keys(batch, table), weights)

    found = sorted((r.key, r.weight) for r in picked.mapInArrow(keys, "key binary, weight double").collect())
    sums = np.cumsum([w for _, w in found])
    cuts = np.searchsorted(sums, np.arange(1, shards) * (sums[-1] / shards)) if found else []
    return sorted({bytes(found[c][0]) for c in cuts})


def _keys(batch, table):
    """Sort keys of rows; rows of equal texts are told apart by their hash and number."""
    near = [key for ids in _id_chunks(batch) for key in near_keys(ids, table)]
    columns = zip(near, *(batch.column(c).to_pylist() for c in ("__hash", "__row")))
    return [key + (h + 2**63).to_bytes(8, "big") + n.to_bytes(8, "big") for key, h, n in columns]


def pack(docs, vocabulary, window=1024, end_id=0, shard_bytes=4_000_000, most_common=0.25,
         place=None, order=None, with_ids=True, doc_id="doc_id", text="text"):
    """One row per piece: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text (null: empty) and `end_id`; special strings in
    a text count as their special ids. Each id lies in exactly one piece, and the pieces of a
    sequence follow each other without a gap. `ids_crc32` is over little-endian unsigned
    32-bit ids; `ids` is left out where `with_ids` is false.

    Shards hold about `shard_bytes` of text (a longer document fills one alone) of documents
    that are near in the order of their keys, from all of `docs`. Seeds come in the order of
    the id, or of `order` (a list of columns). Sequences are numbered by shard (times 2^32) and
    turn; with `place` (a long column, different for all rows, below 2^47) by 2^16 times the
    place of the first document plus the turn among those it begins. Repeated rows and rows with
    a null id are documents of their own. An empty table gives no rows. Only doc_id, text and
    the columns named by `place` and `order` are read.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    shape = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), *[T.StructField(n, T.LongType()) for n in ("start", "length")],
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
        *[T.StructField(n, T.LongType()) for n in ("ids_crc32", "doc_tokens", "sequence_id", "offset")],
    ])
    name, by_place = local_name(docs.sparkSession, vocabulary), place is not None
    plain = docs.select(
        F.col(doc_id).alias("__id"), F.col(text).alias("__text"),
        (F.lit(None) if place is None else place).cast("long").alias("__place"),
        F.struct(*(order or [F.col(doc_id)])).alias("__order"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("__bytes"),
    )
    written = T.StructType([f for f in plain.schema.fields if f.name != "__text"]).add("__ids", "binary").add("__tokens", "long")

    def encode(batches):
        encoder = _encoder(SparkFiles.get(name))
        for batch in (part for whole in batches for part in slices(whole)):
            ids = [
                np.append(encoder.encode_to_numpy(t, allowed_special="all"), end_id).astype("<u4")
                for t in texts_of(batch, "__text")
            ]
            rest = batch.drop_columns(["__text"])
            made = [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())]
            yield pa.RecordBatch.from_arrays([*rest.columns, *made], names=[*rest.schema.names, "__ids", "__tokens"])

    encoded = cut_lineage(plain.mapInArrow(encode, written))
    total = encoded.agg(F.sum("__bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    corpus = _statistics(encoded)
    # the number of a row in the written table splits rows that repeat an id and a text
    rows = encoded.drop("__tokens").withColumns(
        {"__row": F.monotonically_increasing_id(), "__hash": F.xxhash64("__id", "__ids")}
    )
    bounds = _bounds(rows, corpus, shards, total)

    def deal(batches):
        table = _hash_table(corpus) if bounds else None
        for batch in batches:
            number = [bisect_right(bounds, k) for k in _keys(batch, table)] if bounds else [0] * batch.num_rows
            rest = batch.drop_columns(["__row", "__hash", "__bytes"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(number, pa.int64())], names=[*rest.schema.names, "__shard"]
            )

    dealt = rows.mapInArrow(
        deal, T.StructType([f for f in rows.schema.fields if f.name not in ("__row", "__hash", "__bytes")]).add("__shard", "long")
    )

    def lay(group):
        fields = [*group.column("__order").combine_chunks().flatten(), group.column("__ids")]
        names = [str(i) for i in range(len(fields))]
        turn = pa.compute.sort_indices(pa.table(fields, names=names), sort_keys=[(n, "ascending") for n in names])
        group = group.select(["__id", "__ids", "__place", "__shard"]).take(turn)
        ids = [np.frombuffer(x, dtype="<u4") for x in group.column("__ids").to_pylist()]
        number = group.column("__shard")[0].as_py()
        doc, start, length, sequence, offset = map(np.array, zip(*fill_windows(ids, window, most_common, corpus)))
        parts = [ids[d][a:a + n] for d, a, n in zip(doc, start, length)]
        named = (number << 32) + np.arange(sequence[-1] + 1)
        if by_place:
            begins = np.full(len(named), -1)
            begins[sequence[offset == 0]] = doc[offset == 0]
            places, turns = group.column("__place").to_pylist(), {}
            for n, d in enumerate(begins.tolist()):
                turns[d] = turns.get(d, -1) + 1
                named[n] = (places[d] << 16) + turns[d]
        columns = {
            "doc_id": group.column("__id").take(pa.array(doc)),
            "start": start, "length": length,
            "ids": pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())) if with_ids else None,
            "ids_crc32": [zlib.crc32(p.tobytes()) for p in parts],
            "doc_tokens": np.array([len(x) for x in ids])[doc],
            "sequence_id": named[sequence], "offset": offset,
        }
        return pa.table({f: columns[f] for f in shape.names})

    # about SHARDS_A_TASK shards in a task, and as many tasks as the session asks for while there are shards
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(shards, usual), -(-shards // SHARDS_A_TASK))
    return dealt.repartition(tasks, "__shard").groupBy("__shard").applyInArrow(lay, shape)
