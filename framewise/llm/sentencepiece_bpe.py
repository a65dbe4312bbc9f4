"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The words of an Arrow batch that are not known yet are laid into one flat symbol array. Each round looks up the merged
piece of all neighbours at once, takes every word's best rank (a segmented minimum), merges its leftmost occurrences that do
not overlap, and compacts; words without a pair left retire. A merge whose piece could be part of a better-ranked piece is
done once a round, so that the result is the library's, which merges one pair at a time.

No piece holds a space mark behind another character, so words end before space marks; that is checked when the model is
read. The model (a few hundred KB) is broadcast as bytes; the library is used to read its pieces only.

Defined results: null text counts as empty and gives the end id only; texts are coded whole, a long one as a piece of its
own; a null doc_id is passed on; repeated rows are coded each; an empty table gives an empty result; further columns are
passed on by encode() and decode(), but one with the name of a new column is replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.common import give_back, slices, texts_of, tidy_batches, tune
from framewise.llm.hashing import identities, new_key

MARK = "▁"
#: Words kept between batches of a task; when there are more, all are forgotten. It bounds memory, not results.
CACHE_WORDS = 300_000
_NONE = np.iinfo(np.int32).max
_OTHER = 1 << 31  # symbols from here on are characters that no piece holds


class PairTable:
    """(left symbol, right symbol) -> value, for arrays of pairs: two open tables, the second for the first's collisions."""

    BITS = 20

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.parts = []
        rng = np.random.default_rng(1)
        while len(keys):
            odd = rng.integers(1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            slot = self._slot(keys, odd)
            _, first = np.unique(slot, return_index=True)
            held, value = np.full(1 << self.BITS, 2**64 - 1, np.uint64), np.full(1 << self.BITS, -1, np.int32)
            held[slot[first]], value[slot[first]] = keys[first], values[first]
            self.parts.append((odd, held, value))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]

    def _slot(self, keys, odd):
        return ((keys * odd) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        for odd, held, value in self.parts:
            slot = self._slot(keys, odd)
            hit = held[slot] == keys
            out[hit] = value[slot[hit]]
        return out


class Encoder:
    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        pieces = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece holds a space mark behind another character; words can't be merged apart")
        self.end = sp.eos_id()
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        symbols = dict(pieces)
        for p in pieces:
            for c in p:
                symbols.setdefault(c, n + len(symbols))
        self.n = n
        self.of_char = np.arange(0x110000, dtype=np.int64) + _OTHER
        for s, i in symbols.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        self.char_of = {i: s for s, i in symbols.items() if i >= n}
        score = {i: sp.get_score(i) for i in pieces.values()}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = np.full(n, _NONE, np.int32)
        self.alone = np.zeros(n, bool)
        keys, values = [], []
        for p, i in pieces.items():
            self.rank[i] = order[score[i]]
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(i)
                    for x in (a, b):
                        if x in score and score[i] >= score[x]:
                            self.alone[x] = True
        self.pairs = PairTable(np.array(keys, np.uint64), np.array(values, np.int32))
        # Line ends and tabs that no longer piece holds end words too, so that more words recur.
        self.ends_word = np.zeros(256, bool)
        self.ends_word[[ord(c) for c in "\n\t" if not any(c in p and len(p) > 1 for p in pieces)]] = True
        self.text = [b"" if sp.is_control(i) else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else " ⁇ ".encode() if sp.is_unknown(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        self.control = np.array([sp.is_control(i) for i in range(n)])
        self.text_len = np.array([len(x) for x in self.text])
        self.text_at = np.concatenate([[0], np.cumsum(self.text_len)])
        self.text_all = np.frombuffer(b"".join(self.text), np.uint8)
        self.forget()

    def forget(self):
        """Drop the words known so far."""
        self.key = new_key()
        self.known, self.known2, self.code = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of words, which have their space marks."""
        length = np.array([len(w) for w in words], np.int64)
        sym = self.of_char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), length)
        done_sym, done_word = [], []
        while len(sym):
            pair = np.full(len(sym), -1, np.int32)
            near = np.flatnonzero((word[1:] == word[:-1]) & (sym[1:] < _OTHER) & (sym[:-1] < _OTHER))
            pair[near] = self.pairs.get((sym[near].astype(np.uint64) << np.uint64(32)) | sym[near + 1].astype(np.uint64))
            rank = np.where(pair >= 0, self.rank[pair], _NONE)
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.concatenate([begin, [len(sym)]]))
            best = np.repeat(np.minimum.reduceat(rank, begin), size)
            over = best == _NONE
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
                live = ~over
                sym, word, pair, rank, best = sym[live], word[live], pair[live], rank[live], best[live]
                if not len(sym):
                    break
            take = np.flatnonzero(rank == best)
            # Of neighbouring places every other one, from each run's left.
            new_run = np.concatenate([[True], np.diff(take) != 1])
            run_at = np.maximum.accumulate(np.where(new_run, np.arange(len(take)), 0))
            chosen = (np.arange(len(take)) - run_at) % 2 == 0
            first = np.concatenate([[True], word[take][1:] != word[take][:-1]])
            chosen &= first | ~np.repeat(self.alone[pair[take[first]]], np.diff(np.concatenate([np.flatnonzero(first), [len(take)]])))
            take = take[chosen]
            sym[take] = pair[take]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        odd = np.flatnonzero(sym >= self.n)
        if len(odd):  # characters without a piece become their bytes
            spelled = [self.byte[list((chr(s - _OTHER) if s >= _OTHER else self.char_of[s]).encode())] for s in sym[odd].tolist()]
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(x) for x in spelled]
            at = (np.concatenate([[0], np.cumsum(times)]))[odd]
            sym, word = np.repeat(sym, times), np.repeat(word, times)
            spread = np.repeat(at, times[odd]) + np.concatenate([np.arange(k) for k in times[odd]])
            sym[spread] = np.concatenate(spelled)
        return sym.astype(np.int32), np.searchsorted(word, np.arange(len(words) + 1))

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Merge words and keep their ids; the numbers under which they are kept."""
        flat, bounds = self.merge([data[a:b].tobytes().decode().replace(" ", MARK) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        first = len(self.bounds) - 1
        self.flat, self.bounds = np.concatenate([self.flat, flat]), np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
        return np.arange(first, first + len(starts))

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of texts, each with the end id."""
        if len(self.known) > CACHE_WORDS:
            self.forget()
        texts = pc.replace_substring(texts, MARK, " ")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        space, plain = data == 0x20, self.ends_word[data]
        begin = plain.copy()
        begin[1:] |= (space[1:] & ~space[:-1]) | plain[:-1]
        begin[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(data))
        hashes, second = identities(data, starts, ends, self.key)
        distinct, at, word = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        there = np.append(self.known, 0)[place] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        # Words whose first 64 bits are another word's are told by the others, and coded apart.
        strange = second != second[at][word]
        strange |= (there & (np.append(self.known2, 0)[place] != second[at]))[word]
        new = np.flatnonzero(~there)
        if len(new):
            codes = self._learn(data, starts[at[new]], ends[at[new]])
            self.code = np.insert(self.code, place[new], codes)
            self.known = np.insert(self.known, place[new], distinct[new])
            self.known2 = np.insert(self.known2, place[new], second[at[new]])
        code = self.code[np.searchsorted(self.known, distinct)][word]
        if strange.any():
            odd = np.flatnonzero(strange)
            code[odd] = self._learn(data, starts[odd], ends[odd])
        length = np.diff(self.bounds)[code]
        reach = np.concatenate([[0], np.cumsum(length)])
        stops = reach[np.searchsorted(starts, offsets)[1:]]
        ids = np.insert(gather(self.flat, self.bounds[:-1][code], length), stops, self.end)
        return ids.astype(np.int32), np.concatenate([[0], stops + np.arange(1, len(texts) + 1)])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        length = self.text_len[ids]
        data = gather(self.text_all, self.text_at[:-1][ids], length).tobytes()
        reach = np.concatenate([[0], np.cumsum(length)])[bounds].tolist()
        out = []
        for k, (a, b) in enumerate(zip(reach, reach[1:], strict=False)):
            piece = data[a:b]
            mine = ids[bounds[k] : bounds[k + 1]]
            mine = mine[~self.control[mine]] if len(mine) < 3 or self.control[mine[0]] else mine
            if len(mine) and self.text[mine[0]][:1] == b" " and self.byte[0x20] != mine[0]:
                piece = piece[1:]
            try:
                out.append(piece.decode())
            except UnicodeDecodeError:
                out.append(_lenient(piece))
        return out


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start:start+length] for all starts, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else starts, lengths)
    return flat[np.arange(total) + shift]


def _lenient(data: bytes) -> str:
    """Each byte that begins no character becomes U+FFFD."""
    out, i = [], 0
    while i < len(data):
        for k in (1, 2, 3, 4):
            try:
                out.append(data[i : i + k].decode())
                i += k
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


@lru_cache(maxsize=2)
def encoder(model: bytes) -> Encoder:
    return Encoder(model)


def _model(spark, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _without(df: DataFrame, *names: str) -> list[T.StructField]:
    """The fields of df but those; names are told apart as Spark does, without case."""
    gone = {n.lower() for n in names}
    return [f for f in df.schema if f.name.lower() not in gone]


def _lists(flat: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """df without `text` and with `ids`, the text's ids and the end id, and if asked for `decoded`, what the ids decode to.
    A column of df that has the name of a new one is replaced."""
    spark = tune(df.sparkSession)
    model = _model(spark, model_path)
    fields = _without(df, text, ids, decoded or ids)
    new = [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    rest = [f.name for f in fields]

    def run(batches):
        coder = encoder(model.value)
        for b in batches:
            texts = texts_of(b[text])
            for a, z in slices(texts):
                flat, bounds = coder.encode(texts.slice(a, z - a))
                out = [*b.select(rest).slice(a, z - a).columns, _lists(flat, bounds)]
                if decoded:
                    out.append(pa.array(coder.decode(flat, bounds), pa.string()))
                yield pa.record_batch(out, names=[*rest, *(f.name for f in new)])
        coder.forget()
        give_back()

    return df.mapInArrow(run, T.StructType([*fields, *new]))


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """df with `text`, decoded from `ids` (null: the empty text). A column of df that is named `text` is replaced."""
    spark = tune(df.sparkSession)
    model = _model(spark, model_path)
    fields = _without(df, text)
    rest = [f.name for f in fields]

    def run(batches):
        coder = encoder(model.value)
        for b in batches:
            column = b[ids].fill_null([]) if b[ids].null_count else b[ids]
            bounds = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.to_numpy()[bounds[0] : bounds[-1]] if len(column) else np.zeros(0, np.int32)
            yield pa.record_batch([*b.select(rest).columns, pa.array(coder.decode(flat, bounds - bounds[0]) if len(column) else [], pa.string())], names=[*rest, text])

    return df.mapInArrow(tidy_batches(run), T.StructType([*fields, T.StructField(text, T.StringType())]))


def digests(df: DataFrame, model_path: str) -> DataFrame:
    """documents -> doc_id, n_tokens, ids_sha256, decoded_sha256. Both directions in one pass: one worker for each task."""
    back = encode(df.select("doc_id", "text"), model_path, decoded="decoded")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
