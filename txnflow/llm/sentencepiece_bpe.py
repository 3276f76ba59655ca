"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts are cut into words where no vocabulary piece can reach across; each
distinct word of a batch is encoded once. The symbols of all words lie in one
flat array. A round looks up the rank of every neighbouring pair, takes the
minimum of each segment, merges its occurrences leftmost first, and compacts
the array; segments without a mergeable pair leave. The library merges one
pair at a time; merging all occurrences of a segment's best pair at once gives
the same pieces unless the merged piece could join a better or equal pair with
a neighbour. For such pieces (found when the vocabulary is read) only the
leftmost occurrence is merged in a round.

Defined cases: NULL is the empty text, whose encoding is the end id alone;
rows that repeat a text are encoded alike; characters outside the vocabulary
become their UTF-8 bytes; other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.llm.common import row_struct, whole_text

BLANK = "▁"
#: Distinct words kept between batches of one task, and ids kept for each on average.
KEPT_WORDS = 400_000
KEPT_CHARS = 16
#: Characters of text handled at once inside a batch.
CHUNK_CHARS = 2_000_000

_NONE = np.int64(2**40)
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def _runs(piece: dict[int, int]) -> list[list[int]] | None:
    """The pieces of 0, 1, ... blanks when all their merges tie and so go from the left.

    ``piece`` has ids by length. NULL if runs longer than the longest piece do not repeat it.
    """

    def merged(n: int) -> list[int]:
        parts = [1] * n
        while (i := next((i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in piece), None)) is not None:
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    longest = max(piece)
    runs = [merged(n) for n in range(3 * longest + 1)]
    if any(runs[n] != [longest] + runs[n - longest] for n in range(longest, len(runs))):
        return None
    return [[piece[k] for k in r] for r in runs[: longest + 1]]


class Vocabulary:
    """The tables of one BPE model; a few MB that go to every task with the function."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(model)
        spec, train = m.normalizer_spec, m.trainer_spec
        if train.model_type != train.BPE or not train.byte_fallback or train.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with byte fallback and white space as prefix is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("a model that leaves its text as it is, but for the dummy prefix, is needed")
        self.size, self.end = len(m.pieces), train.eos_id
        self.unknown_surface = train.unk_surface
        self.pieces = [p.piece for p in m.pieces]
        self.kinds = np.array([p.type for p in m.pieces])
        self.bytes = np.zeros(256, np.int32)
        for i in np.flatnonzero(self.kinds == _BYTE):
            self.bytes[int(self.pieces[i][3:5], 16)] = i
        self._tables([(p.piece, p.score, i) for i, p in enumerate(m.pieces) if p.type == _NORMAL])

    def _tables(self, normal: list[tuple[str, float, int]]) -> None:
        symbol = {p: i for p, _, i in normal}
        for c in sorted({c for p, _, _ in normal for c in p} - symbol.keys()):
            symbol[c] = self.size + len(symbol)  # a character that is only part of pieces
        chars = sorted((ord(c), s) for c, s in symbol.items() if len(c) == 1)
        self.chars = np.array([c for c, _ in chars], np.int64)
        self.char_symbols = np.array([s for _, s in chars], np.int64)
        self.blank = symbol.get(BLANK, -1)

        many = [(p, s, i) for p, s, i in normal if len(p) > 1]
        blanks = sorted((len(p), s, i) for p, s, i in many if not p.strip(BLANK))
        lowest = min((s for _, s, _ in many), default=0)
        #: Ids of a run of n blanks, for n up to the longest piece, if such runs are merged last.
        self.blank_runs = _runs({n: i for n, _, i in blanks} | {1: self.blank}) if {s for _, s, _ in blanks} == {lowest} else None
        if self.blank_runs:
            many = [x for x in many if x[0].strip(BLANK)]

        scores = sorted({s for _, s, _ in many}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        self.step = np.int64(2 * self.size + len(symbol))
        pairs, risky = {}, np.zeros(len(scores) + 1, bool)
        ranks = {p: rank[s] for p, s, _ in many}
        risky[:-1] = np.bincount([rank[s] for _, s, _ in many], minlength=len(scores))[: len(scores)] > 1
        for p, s, i in many:
            for cut in range(1, len(p)):
                a, b = symbol.get(p[:cut]), symbol.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a * int(self.step) + b] = (rank[s], i)
                    for part in (p[:cut], p[cut:]):
                        if part in ranks and ranks[part] >= rank[s]:
                            risky[ranks[part]] = True
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys = np.append(keys, np.iinfo(np.int64).max)
        self.pair_ranks = np.array([pairs[k][0] for k in keys.tolist()] + [_NONE], np.int64)
        self.pair_symbols = np.array([pairs[k][1] for k in keys.tolist()] + [-1], np.int64)
        self.risky = risky
        inside = {(a, b) for p, _, _ in many for a, b in zip(p, p[1:])}
        self.bigrams = np.array(sorted((ord(a) << 21) + ord(b) for a, b in inside) + [1 << 62], np.int64)
        #: Words may begin at a blank run or stand at a line break only if no piece reaches across.
        blank_inside = any(b == BLANK and a != BLANK for a, b in inside)
        breaks = any("\n" in ab for ab in inside)
        other = BLANK if breaks else BLANK + "\n"
        self.words = re.compile(r"(?s).+" if blank_inside else rf"{BLANK}*[^{other}]+|{BLANK}+" + ("" if breaks else r"|\n"))

    def segments(self, cps: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Numbers of the stretches within which merges can happen."""
        key = (cps[:-1] << 21) + cps[1:]
        joined = self.bigrams[np.searchsorted(self.bigrams, key)] == key
        return np.concatenate([[0], np.cumsum(~joined | (words[1:] != words[:-1]))]) if len(cps) else words

    def merged(self, sym: np.ndarray, seg: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, first character positions) after all merges, in the order of the text."""
        done = []
        while len(sym):
            known = (sym[:-1] >= 0) & (sym[1:] >= 0) & (seg[1:] == seg[:-1])
            key = np.where(known, sym[:-1] * self.step + sym[1:], -1)
            found = np.searchsorted(self.pair_keys, key)
            found = np.where(self.pair_keys[found] == key, found, len(self.pair_keys) - 1)
            rank = np.append(self.pair_ranks[found], _NONE)
            starts = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
            best = np.minimum.reduceat(rank, starts)
            best = np.repeat(best, np.diff(np.append(starts, len(sym))))
            live = best < _NONE
            done.append((sym[~live], at[~live]))
            p = np.flatnonzero((rank == best) & live)
            if not len(p):
                break
            begins = np.append(True, p[1:] != p[:-1] + 1)  # of runs of overlapping pairs
            run = np.flatnonzero(begins)[np.cumsum(begins) - 1]
            p = p[(np.arange(len(p)) - run) % 2 == 0]
            p = p[self._at_once(sym, seg, p, self.pair_symbols[found[p]], best[p])]
            sym = sym.copy()
            sym[p] = self.pair_symbols[found[p]]
            live[p + 1] = False
            sym, seg, at = sym[live], seg[live], at[live]
        sym, at = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(at, kind="stable")
        return sym[order], at[order]

    def _at_once(self, sym, seg, p, new, best) -> np.ndarray:
        """Which of the pairs at ``p`` can merge in one round, to the symbols ``new``.

        Where a merge makes a pair that is as good or better, that one comes
        before the pairs to the right: they wait for the next round.
        """
        use = np.ones(len(p), bool)
        some = np.flatnonzero(self.risky[best])
        if not len(some):
            return use
        q, x, bound = p[some], new[some], best[some]
        before, after = np.maximum(q - 1, 0), np.minimum(q + 2, len(sym) - 1)
        has_before = (q > 0) & (seg[before] == seg[q])
        has_after = (q + 2 < len(sym)) & (seg[after] == seg[q])
        beside = np.append(False, q[1:] == q[:-1] + 2) & has_before
        better = self._ranks(sym[before], x, has_before) <= bound
        better |= self._ranks(x, sym[after], has_after) <= bound
        better |= self._ranks(np.roll(x, 1), x, beside) <= bound
        earlier = np.cumsum(better) - better
        starts = np.append(True, seg[q[1:]] != seg[q[:-1]])
        use[some] = earlier == earlier[np.flatnonzero(starts)][np.cumsum(starts) - 1]
        return use

    def _ranks(self, a: np.ndarray, b: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b), where ``real``."""
        key = np.where(real & (a >= 0) & (b >= 0), a * self.step + b, -1)
        found = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[found] == key, self.pair_ranks[found], _NONE)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each word)."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        cps = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        if not len(cps):
            return np.zeros(0, np.int32), lens
        word = np.repeat(np.arange(len(words)), lens)
        i = np.minimum(np.searchsorted(self.chars, cps), len(self.chars) - 1)
        sym = np.where(self.chars[i] == cps, self.char_symbols[i], -1)
        sym, at = self.merged(sym, self.segments(cps, word), np.arange(len(cps)))
        counts = np.ones(len(sym), np.int64)
        values: dict[int, list[int]] = {}
        for p in np.flatnonzero((sym < 0) | (sym >= self.size)).tolist():
            values[p] = [int(self.bytes[b]) for b in chr(int(cps[at[p]])).encode()]
            counts[p] = len(values[p])
        if self.blank_runs:
            self._blank_runs(sym, word[at], counts, values)
        starts = np.cumsum(counts) - counts
        ids = np.zeros(int(counts.sum()), np.int32)
        plain = counts == 1
        ids[starts[plain]] = sym[plain]
        for p, v in values.items():
            ids[starts[p] : starts[p] + len(v)] = v
        return ids, np.bincount(word[at], counts, len(words)).astype(np.int64)

    def _blank_runs(self, sym: np.ndarray, word: np.ndarray, counts: np.ndarray, values: dict[int, list[int]]) -> None:
        """Blanks that no better merge took: the longest runs from the left, then the rest."""
        blank = np.flatnonzero(sym == self.blank)
        if not len(blank):
            return
        begins = np.append(True, (blank[1:] != blank[:-1] + 1) | (word[blank[1:]] != word[blank[:-1]]))
        first = blank[begins]
        size = np.diff(np.append(np.flatnonzero(begins), len(blank)))
        longest = len(self.blank_runs) - 1
        for p, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
            full, rest = divmod(n, longest)
            values[p] = self.blank_runs[-1] * full + self.blank_runs[rest]
            counts[p : p + n] = 0
            counts[p] = len(values[p])

    def split(self, text: str) -> list[str]:
        return self.words.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def decode(self, ids: list[int], start: bool = True) -> str:
        """The text of ``ids``; at the start of a text the dummy prefix goes."""
        out, raw = [], bytearray()
        for i in ids:
            kind = self.kinds[i]
            if kind == _BYTE:
                raw.append(int(self.pieces[i][3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if kind == _NORMAL:
                out.append(self.pieces[i])
            elif kind == _UNKNOWN:
                out.append(self.unknown_surface)
        out.append(raw.decode("utf-8", "replace"))
        text = "".join(out)
        return (text[1:] if start and text.startswith(BLANK) else text).replace(BLANK, " ")


class _Words:
    """Encodings of distinct words, as offsets into one flat array; forgotten when there are too many."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.lens, self.texts = np.zeros(0, np.int32), np.zeros(0, np.int64), []

    def of(self, words: list[str]) -> np.ndarray:
        """Indices of ``words``, new ones encoded first."""
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        if new:
            ids, lens = self.v.encode_words(new)
            ends = np.cumsum(lens)
            raw = np.concatenate([[0], np.cumsum(self.v.kinds[ids] != _NORMAL)])
            plain = (raw[ends] == raw[ends - lens]).tolist()
            pieces = [self.v.pieces[i] for i in ids.tolist()]
            for w, a, b, fast in zip(new, (ends - lens).tolist(), ends.tolist(), plain):
                self.index[w] = len(self.index)
                text = "".join(pieces[a:b]).replace(BLANK, " ") if fast else self.v.decode(ids[a:b].tolist(), start=False)
                self.texts.append(text)
            self.ids, self.lens = np.concatenate([self.ids, ids]), np.concatenate([self.lens, lens])
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def trim(self) -> None:
        if len(self.index) > KEPT_WORDS or len(self.ids) > KEPT_WORDS * KEPT_CHARS:
            self.clear()


def _encode_chunk(cache: _Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(flat ids with an end id after each text, ids of each text, decoded texts)."""
    lists = [cache.v.split(t) for t in texts]
    at = cache.of([w for ws in lists for w in ws])
    words = np.fromiter(map(len, lists), np.int64, len(lists))
    starts = np.cumsum(cache.lens) - cache.lens
    sizes = cache.lens[at]
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ids = cache.ids[np.repeat(starts[at], sizes) + within]
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(words)]
    decoded, a, names = [], 0, cache.texts
    for n in words.tolist():
        whole = "".join([names[i] for i in at[a : a + n].tolist()])
        decoded.append(whole[1:] if whole.startswith(" ") else whole)
        a += n
    counts = np.diff(np.concatenate([[0], ends])) + 1
    return np.insert(ids, ends, cache.v.end), counts, decoded


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with the columns ids (end id included) and decoded (the text of those ids)."""
    with open(model_path, "rb") as f:
        vocabulary = Vocabulary(f.read())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            row = 0
            while row < len(texts):
                end, chars = row, 0
                while end < len(texts) and (end == row or chars + len(texts[end]) <= CHUNK_CHARS):
                    chars += len(texts[end])
                    end += 1
                ids, counts, decoded = _encode_chunk(cache, texts[row:end])
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                rest = batch.column("row").slice(row, end - row)
                columns = [rest, pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"])
                cache.trim()
                row = end

    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    source = docs.select(row_struct(keep).alias("row"), whole_text(docs).alias("text"))
    made = T.StructType.fromDDL("ids array<int>, decoded string")
    return source.mapInArrow(task, T.StructType([source.schema["row"], *made.fields])).select("row.*", *made.names)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what ``encode`` returns."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
