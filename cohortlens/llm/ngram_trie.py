"""Bigram language model (A-Z in lower case) in Elias-Fano tries, trained and queried shard by shard.

p(w | v) = max(c(v, w) - D, 0) / c(v) + D n(v) / c(v) p(w), with n(v) the distinct successors of v and p(w) the
additively smoothed unigram probability (an unknown context leaves p(w)).

1. Documents become blocks of tokens (a bucketed table, so that answers join them without moving them again).
2. Words: each block asks the shard of a word (by hash) for its count in all training documents.
3. Bigrams: each block sends its distinct bigrams with their training counts to the shard of the context. The
   shard adds them up, builds the trie of its part (mapped into memory from one file), and looks up every bigram that
   was asked for. A frequent context is spread over many shards by its successors.
4. Each block takes the answers and sums up the scores of its documents.

What is shuffled is one entry per block and distinct word or bigram, grouped in one row per block and shard. Words
are known by 64-bit hashes, successors inside a context by 40 bits of them.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from .common import crc32_mod, slices
from .elias_fano import Trie

DISCOUNT, ADDED = 0.75, 0.1
BLOCK_BYTES = 8 << 20
ENTRIES_PER_SHARD, LEAST_SHARDS = 1_000_000, 48
SPLIT = 2_000_000                              # a context is spread over one more shard for so many occurrences
STEPS = 4096                                   # quantisation: steps per decade of probability
END, START = (xxhash.xxh3_64_intdigest(x) for x in (b"\n", b"\t"))    # no words: they hold white space
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LOW40 = np.uint64(2**40 - 1)
_POSITIVE = np.uint64(2**63 - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _binary(x: np.ndarray, dtype) -> bytes:
    return x.astype(dtype).tobytes()


def lowered(text: str | None) -> list[bytes]:
    """Words with A-Z (no other letter) in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def tokenised(docs: DataFrame, id_col: str, text_col: str, folds: int) -> DataFrame:
    """Blocks: ids, held (fold 0), sizes (tokens with the end), words (distinct hashes, sorted), tokens (places in words)."""
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), (crc32_mod(id_col, folds) == 0).alias("held"), F.col(text_col).alias("text"))

    def compute(batches):
        task = TaskContext.get().partitionId()
        for number, part in enumerate(slices(batches, "text", BLOCK_BYTES)):
            ids, tokens, sizes = {b"\n": 0}, [], []
            for text in part.column("text").to_pylist():
                t = [ids.setdefault(w, len(ids)) for w in lowered(text)]
                tokens.append(np.array([*t, 0], np.int64))
                sizes.append(len(t) + 1)
            known, place = np.unique(np.array([xxhash.xxh3_64_intdigest(w) for w in ids], np.uint64), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) | number]), _one(part.column("id")), _one(part.column("held")), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([_binary(known, "<u8")], pa.binary()), pa.array([_binary(place[np.concatenate(tokens)], "<i4")], pa.binary()), pa.array([len(known)])],
                ["block", "ids", "held", "sizes", "words", "tokens", "n_words"])
    return rows.mapInArrow(compute, f"block long, ids array<{kind.simpleString()}>, held array<boolean>, sizes array<int>, words binary, tokens binary, n_words long")


def _one(column: pa.Array) -> pa.Array:
    """The column as the only list of a list column."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


class _Block:
    """Arrays of one block row."""

    def __init__(self, row: dict):
        self.held, self.sizes = np.array(row["held"], bool), np.array(row["sizes"], np.int64)
        self.words, self.tokens = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["tokens"], "<i4").astype(np.int64)
        self.train = ~np.repeat(self.held, self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes

    def shards(self, n: int) -> np.ndarray:
        return (_mix(self.words) % np.uint64(n)).astype(np.int64)

    def counts(self, answers: list[dict], n: int) -> np.ndarray:
        """Training count of each word, from the answers of the word shards."""
        order = np.argsort(self.shards(n), kind="stable")
        out = np.empty(len(self.words), np.int64)
        out[order] = np.concatenate([np.frombuffer(a["counts"], "<i8") for a in sorted(answers, key=lambda a: a["shard"])])
        return out

    def bigrams(self, counts: np.ndarray, n: int):
        """Distinct bigrams in shard order: dict of arrays, and for each token the place of its bigram.

        ``key``: context key (a frequent context has several, one per part of its successors).
        """
        v = len(self.words)
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        before[self.first] = v                                         # the start
        pair, place = np.unique(before * np.int64(v + 1) + self.tokens, return_inverse=True)
        seen = np.bincount(place, self.train, len(pair)).astype(np.int64)
        context, word = pair // (v + 1), pair % (v + 1)
        names = np.append(self.words, np.uint64(START))
        total = np.append(counts, self.starts)                         # occurrences of each context in training
        parts = 1 + total // SPLIT
        part = (_mix(self.words[word] ^ _GOLD) % parts[context].astype(np.uint64))
        # every part of a context that occurs here is asked for, so that its successors can be added up
        every = np.unique(context)
        extra = np.repeat(every, parts[every])
        extra_part = (np.arange(len(extra)) - np.repeat(np.cumsum(parts[every]) - parts[every], parts[every])).astype(np.uint64)
        key_of = lambda c, p: _mix(names[c] + p * _GOLD) & _POSITIVE
        keys, index = np.unique(key_of(extra, extra_part), return_index=True)
        owner = extra[index]
        at = np.searchsorted(keys, key_of(context, part))
        shard = (keys % np.uint64(n)).astype(np.int64)
        low = self.words[word] & _LOW40
        order = np.lexsort((low, keys[at], shard[at]))
        key_order = np.lexsort((keys, shard))
        where = np.empty(len(order), np.int64)
        where[order] = np.arange(len(order))
        return {"keys": keys[key_order], "owner": owner[key_order], "shard": shard[key_order], "total": total[owner[key_order]],
                "word": word[order], "low": low[order], "seen": seen[order], "pair_shard": shard[at][order],
                "runs": np.bincount(at, minlength=len(keys))[key_order]}, where[place]

    starts = 0


def _answers(rows: DataFrame) -> DataFrame:
    """All answers of a block in one row (as many entries as the block has)."""
    return rows.groupBy("block").agg(F.collect_list(F.struct(*[c for c in rows.columns if c != "block"])).alias("answers"))


def _rows(batches):
    """Rows as dicts, one at a time (a row is a whole block or its entries of a shard)."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _by_shard(batches):
    """The rows of one shard at a time; the input is sorted by shard."""
    held: list = []
    for row in _rows(batches):
        if held and row["shard"] != held[-1]["shard"]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def word_counts(blocks: DataFrame, n: int) -> DataFrame:
    """(block, shard, counts) answers, with the shard's tokens and types on its first row."""
    def ask(batches):
        for row in _rows(batches):
            b = _Block(row)
            seen, shard = np.bincount(b.tokens, b.train, len(b.words)), b.shards(n)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(n + 1))
            for s in range(n):
                at = order[cut[s]:cut[s + 1]]
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "block": [row["block"]],
                                                  "words": [_binary(b.words[at], "<u8")], "seen": [_binary(seen[at], "<u4")]})
    requests = blocks.mapInArrow(ask, "shard int, block long, words binary, seen binary").repartition("shard").sortWithinPartitions("shard")

    def count(batches):
        for rows in _by_shard(batches):
            parts = [np.frombuffer(r["words"], "<u8") for r in rows]
            known, place = np.unique(np.concatenate(parts), return_inverse=True)
            total = np.bincount(place, np.concatenate([np.frombuffer(r["seen"], "<u4") for r in rows]), len(known)).astype(np.int64)
            answer = np.split(total[place], np.cumsum([len(p) for p in parts])[:-1])
            lead = [1] + [0] * (len(rows) - 1)
            yield pa.RecordBatch.from_pydict({
                "block": [r["block"] for r in rows], "shard": pa.array([r["shard"] for r in rows], pa.int32()), "counts": [_binary(a, "<i8") for a in answer],
                "tokens": [int(total.sum()) * x for x in lead], "types": [int((total > 0).sum()) * x for x in lead]})
    return requests.mapInArrow(count, "block long, shard int, counts binary, tokens long, types long")


def _quantised(p: np.ndarray) -> np.ndarray:
    """1 + steps below probability 1, in 16 bits; 0 stands for an absent entry."""
    return (1 + np.clip(np.round(-np.log10(p) * STEPS), 0, 65_534)).astype(np.uint16)


def _probability(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) / STEPS), 0.0)


def bigram_answers(asking: DataFrame, n_words: int, n: int, starts: int) -> DataFrame:
    """(block, shard, codes, degrees) for the bigrams and contexts of every block."""
    def ask(batches):
        for row in _rows(batches):
            b = _Block(row)
            b.starts = starts
            g, _ = b.bigrams(b.counts(row["answers"], n_words), n)
            cut, pairs = np.searchsorted(g["shard"], np.arange(n + 1)), np.searchsorted(g["pair_shard"], np.arange(n + 1))
            low = np.ascontiguousarray(g["low"].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5]
            for s in range(n):
                k, p = slice(cut[s], cut[s + 1]), slice(pairs[s], pairs[s + 1])
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([s], pa.int32()), "block": [row["block"]], "keys": [_binary(g["keys"][k], "<u8")],
                    "totals": [_binary(g["total"][k], "<i8")], "runs": [_binary(g["runs"][k], "<u4")],
                    "low": [low[p].tobytes()], "seen": [_binary(g["seen"][p], "<u4")]})
    requests = asking.mapInArrow(ask, "shard int, block long, keys binary, totals binary, runs binary, low binary, seen binary")
    requests = requests.repartition("shard").sortWithinPartitions("shard")

    def answer(batches):
        for rows in _by_shard(batches):
            keys = [np.frombuffer(r["keys"], "<u8") for r in rows]
            context = [np.repeat(k, np.frombuffer(r["runs"], "<u4")) for k, r in zip(keys, rows)]
            word = []
            for r in rows:
                wide = np.zeros((len(r["low"]) // 5, 8), np.uint8)
                wide[:, :5] = np.frombuffer(r["low"], np.uint8).reshape(-1, 5)
                word.append(wide.view("<u8").ravel())
            seen = np.concatenate([np.frombuffer(r["seen"], "<u4") for r in rows])
            # distinct bigrams of all blocks, so that the trie is read once whatever the number of blocks
            every_context, every_word = np.concatenate(context), np.concatenate(word)
            order = np.lexsort((every_word, every_context))
            c, w = every_context[order], every_word[order]
            new = np.ones(len(c), bool)
            new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
            head = np.flatnonzero(new)
            count = np.add.reduceat(seen[order].astype(np.float64), head) if len(head) else np.zeros(0)
            c, w, trained = c[head], w[head], count > 0
            known, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            total = np.concatenate([np.frombuffer(r["totals"], "<i8") for r in rows])[first]
            p = (count[trained] - DISCOUNT) / total[np.searchsorted(known, c[trained])]
            trie = Trie.build(c[trained], w[trained], _quantised(p)).map_to()
            codes = np.empty(len(order), np.uint16)
            codes[order] = trie.lookup(c, w)[np.cumsum(new) - 1]
            split = lambda x, parts: np.split(x, np.cumsum([len(p) for p in parts])[:-1])
            yield pa.RecordBatch.from_pydict({
                "block": [r["block"] for r in rows], "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                "codes": [_binary(x, "<u2") for x in split(codes, word)], "degrees": [_binary(x, "<u4") for x in split(trie.degrees(known)[place], keys)]})
    return requests.mapInArrow(answer, "block long, shard int, codes binary, degrees binary")


def score_corpus(docs: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Rows whose crc32(id) mod ``folds`` is 0 are held out, all others train. Null and empty texts have one token, the
    end; repeated rows count as often as they occur, null ids hash as empty text. Other columns are ignored. Without
    training rows every probability is 1. Empty input gives an empty result.
    """
    spark = docs.sparkSession
    name = f"ngram_blocks_{uuid.uuid4().hex}"
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"            # the shared folder, wherever the warehouse is
    tokenised(docs, id_col, text_col, folds).write.bucketBy(buckets, "block").options(compression="zstd", path=path).saveAsTable(name)
    blocks = spark.table(name)
    entries, starts = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)),
                                 F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()
    n_words = n = LEAST_SHARDS + int(entries) * 4 // ENTRIES_PER_SHARD
    counts = cut_lineage(word_counts(blocks, n_words), "words")
    tokens, types = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    asked = _answers(counts.select("block", "shard", "counts"))
    answers = cut_lineage(bigram_answers(blocks.join(asked, "block"), n_words, n, starts), "bigrams")
    ready = blocks.join(asked, "block").join(_answers(answers).withColumnRenamed("answers", "found"), "block")
    kind = docs.schema[id_col].dataType
    schema = "id " + kind.simpleString() + ", held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(batches):
        for batch in batches:
            ids = batch.column("ids")
            for i, row in enumerate(_rows([batch.drop_columns(["ids"])])):
                b = _Block(row)
                b.starts = starts
                count = b.counts(row["answers"], n_words)
                g, place = b.bigrams(count, n)
                found = sorted(row["found"], key=lambda a: a["shard"])
                seen = _probability(np.concatenate([np.frombuffer(a["codes"], "<u2") for a in found]))
                degree = np.bincount(g["owner"], np.concatenate([np.frombuffer(a["degrees"], "<u4") for a in found]), len(b.words) + 1)
                unigram = (count + ADDED) / (tokens + ADDED * (types + 1))
                context = np.repeat(g["owner"], g["runs"])
                total = np.append(count, starts)[context]
                p = np.where(total > 0, seen + DISCOUNT * degree[context] / np.maximum(total, 1) * unigram[g["word"]], unigram[g["word"]])
                sums = lambda x: np.add.reduceat(x, b.first)
                yield pa.RecordBatch.from_arrays(
                    [ids[i].values, pa.array(b.held), pa.array(b.sizes), pa.array(sums((count[b.tokens] > 0).astype(np.int64))),
                     pa.array(np.full(len(b.sizes), tokens)), pa.array(sums(np.log10(unigram)[b.tokens])), pa.array(sums(np.log10(p)[place]))],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    out = cut_lineage(ready.mapInArrow(score, schema).withColumnRenamed("id", id_col), "scores")
    spark.sql(f"DROP TABLE {name}")
    return out
