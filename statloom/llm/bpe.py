"""Byte-pair encoding and decoding with a given vocabulary file (never trained here).

Encoding keeps an index from each pair to all its positions in the distinct words of a
partition's batch.  Active ranks are applied in ascending order: all positions of the
lowest pair merge at once, and only the lists of the pairs beside them change.  The
vocabulary form handled is the word-end form: NFC, lower case, white space dropped,
words by a pattern, bytes as characters, ``</w>`` on the last one.

Defined results
    NULL and empty texts give no ids; no ids decode to an empty text.  Special tokens
    spelled out in a text are found before anything else, as the file asks.  A word
    of any length is one entry of the index.  Ids without a token decode to nothing.
    Letters and numbers are those of Unicode 16, small letters those of Unicode 17, as
    in the library; letters composed by rules newer than Python's tables stay apart.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from statloom.llm.text import filled, give_back, in_portions

BYTES_AT_ONCE = 4 << 20
#: Finished words a task keeps.
MOST_WORDS = 400_000
#: Shorter position lists are handled place by place.
FEW = 40


def byte_characters() -> list[str]:
    """Character that stands for each byte: printable ones for themselves, the rest from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    odd = iter(range(256, 512))
    return [chr(b if b in plain else next(odd)) for b in range(256)]


# Letters and numbers that Unicode 16 added to version 15.1, first and last code point.
NEWER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEWER_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
# Capital letters since Unicode 16, first and last code point and the first one's small letter.
NEWER_CAPITALS = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
]
SMALL = {c: small + c - first for first, last, small in NEWER_CAPITALS for c in range(first, last + 1)}
_CAPITAL = re.compile("[" + "".join(f"{chr(first)}-{chr(last)}" for first, last, _ in NEWER_CAPITALS) + "]")


#: No plane from here on holds letters or numbers.
LETTERS_END = 0x40000


def code_points(category: str) -> tuple[str, str]:
    """Insides of pattern sets with all code points of a general category (L letters, N numbers): up to U+FFFF, and above."""
    newer = {"L": NEWER_LETTERS, "N": NEWER_NUMBERS}[category]
    inside = np.fromiter((unicodedata.category(chr(c))[0] == category for c in range(LETTERS_END)), bool, LETTERS_END)
    for first, last in newer:
        inside[first : last + 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    spans = [(first, last - 1) for first, last in edges.reshape(-1, 2).tolist()]
    low, high = ("".join(f"{chr(a)}-{chr(b)}" for a, b in spans if (a > 0xFFFF) == above) for above in (False, True))
    return low, high


def split_pattern(split: str, space: str) -> str:
    """The file's word pattern with its classes spelled out.

    Sets that reach above U+FFFF are slow, so in the usual forms of the classes those code points are looked at apart.
    """
    (letters, more_letters), (numbers, more_numbers) = code_points("L"), code_points("N")
    high = "(?=[\U00010000-\U0010FFFF])"
    forms = {
        r"[\p{L}]+": f"(?:[{letters}]+|{high}[{more_letters}]+)+",
        r"[\p{N}]": f"(?:[{numbers}]|{high}[{more_numbers}])",
        r"[^\s\p{L}\p{N}]+": f"(?:[^{space}{letters}{numbers}\U00010000-\U0010FFFF]+|{high}[^{more_letters}{more_numbers}])+",
        r"\s": space,
        r"\p{L}": letters + more_letters,
        r"\p{N}": numbers + more_numbers,
    }
    for form, spelled in forms.items():
        split = split.replace(form, spelled)
    return f"(?![{space}])(?:{split})"


class Vocabulary:
    """Tokens, ranks and text rules of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        end = model["end_of_word_suffix"]
        chars = byte_characters()
        self.inner = np.array([self.ids[c] for c in chars], np.int32)
        self.last = np.array([self.ids[c + end] for c in chars], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        right = np.array([self.ids[b] for _, b in pairs], np.int64)
        self.made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        self.left, self.right = left, right
        keys = left << 32 | right
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        self.rank_of = {k: r for r, k in enumerate(keys.tolist())}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        space = r"\t-\r \x85\xa0  -     　"
        split = split_pattern(split, space)
        self.word = re.compile(split)
        self.word_or_break = re.compile("\n|" + split)
        self.found = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.by_key[at], -1)

    def lowered(self, text: str) -> str:
        """Composed, in lower case letter by letter: that of a letter (sigma) does not depend on its place."""
        flat = unicodedata.normalize("NFC", text)
        if _CAPITAL.search(flat):
            flat = flat.translate(SMALL)
        return "".join(c.lower() for c in flat) if "Σ" in flat else flat.lower()

    def is_odd(self, text: str) -> bool:
        return "Σ" in text or any(s in text for s in self.special)

    def words(self, text: str) -> list[str | int]:
        """Words of a text; ids stand for special tokens."""
        out: list[str | int] = []
        for part in self.found.split(text) if self.found else [text]:
            if part in self.special:
                out.append(self.special[part])
            else:
                out += self.word.findall(self.lowered(part))
        return out


class PairIndex:
    """Positions of every pair in a set of words, kept up to date while ranks are applied."""

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        self.vocabulary = vocabulary
        raw = np.frombuffer("".join([w + "\n" for w in words]).encode("utf-8", "replace"), np.uint8)
        inside = raw != 10  # words hold no line feed
        lengths = np.diff(np.append(-1, np.flatnonzero(~inside))) - 1
        raw = raw[inside]
        self.ends = np.cumsum(lengths)
        n = len(raw)
        self.symbol = vocabulary.inner[raw]
        last = self.ends - 1
        self.symbol[last] = vocabulary.last[raw[last]]
        self.next = np.arange(1, n + 1, dtype=np.int32)
        self.next[last] = -1
        self.before = np.arange(-1, n - 1, dtype=np.int32)
        self.before[self.ends - lengths] = -1
        self.positions: dict[int, list[np.ndarray]] = {}
        self.single: dict[int, list[int]] = {}
        self.active: list[int] = []
        self._add(np.flatnonzero(self.next >= 0).astype(np.int32))

    def _add(self, at: np.ndarray) -> None:
        """Enter the pairs that start at these positions."""
        ranks = self.vocabulary.ranks(self.symbol[at], self.symbol[self.next[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(at)]):
            if end > start:
                rank = int(ranks[start])
                self._activate(rank)
                self.positions.setdefault(rank, []).append(at[start:end])

    def _activate(self, rank: int) -> None:
        if rank not in self.positions and rank not in self.single:
            heapq.heappush(self.active, rank)

    def _add_one(self, at: int, after: int) -> None:
        rank = self.vocabulary.rank_of.get(self.symbol.item(at) << 32 | self.symbol.item(after))
        if rank is not None:
            self._activate(rank)
            self.single.setdefault(rank, []).append(at)

    def _merge_few(self, rank: int, positions: list[int]) -> None:
        """The same as for whole lists, place by place from the left; a stale neighbour fails its check later."""
        v = self.vocabulary
        a, b, made = int(v.left[rank]), int(v.right[rank]), int(v.made[rank])
        symbol, following, before = self.symbol, self.next, self.before
        for at in positions:
            gone = following.item(at)
            if gone < 0 or symbol.item(at) != a or symbol.item(gone) != b:
                continue
            after, left = following.item(gone), before.item(at)
            symbol[at], symbol[gone], following[at] = made, -1, after
            if after >= 0:
                before[after] = at
                self._add_one(at, after)
            if left >= 0:
                self._add_one(left, at)

    def _free(self, at: np.ndarray) -> np.ndarray:
        """Of equal neighbours (a a a) every second one merges, from the left."""
        taken, out = -1, []
        for p in at.tolist():
            if p != taken:
                out.append(p)
                taken = int(self.next[p])
        return np.array(out, np.int32)

    def merge_all(self) -> None:
        v = self.vocabulary
        while self.active:
            rank = heapq.heappop(self.active)
            lists, single = self.positions.pop(rank, []), self.single.pop(rank, [])
            if sum(map(len, lists)) + len(single) <= FEW:
                self._merge_few(rank, sorted({*single, *[p for x in lists for p in x.tolist()]}))
                continue
            at = np.sort(np.concatenate([*lists, np.array(single, np.int32)]))
            at = at[np.append(True, at[1:] != at[:-1])]
            a, b = v.left[rank], v.right[rank]
            after = self.next[at]
            at = at[(self.symbol[at] == a) & (after >= 0) & (self.symbol[after] == b)]
            if a == b and len(at) > 1:
                at = self._free(at)
            if not len(at):
                continue
            gone = self.next[at]
            after = self.next[gone]
            self.symbol[at] = v.made[rank]
            self.symbol[gone] = -1
            self.next[at] = after
            self.before[after[after >= 0]] = at[after >= 0]
            left = self.before[at]
            self._add(np.concatenate([left[left >= 0], at[after >= 0]]))

    def tokens(self) -> Lists:
        """Ids of each word."""
        alive = self.symbol >= 0
        return Lists(self.symbol[alive].astype(np.int32), np.append(0, np.cumsum(alive)[self.ends - 1]))


class Lists:
    """Number lists one after the other, with their bounds."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray):
        self.flat, self.bounds = flat, bounds

    def strung(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists with these numbers, joined, and where each begins and the last ends."""
        starts = self.bounds[codes]
        lengths = self.bounds[codes + 1] - starts
        ends = np.append(0, np.cumsum(lengths))
        at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)
        return self.flat[at], ends


def numbers() -> defaultdict:
    """Numbers things from 0 as they come."""
    return defaultdict(count().__next__)


def stretches(text: str) -> list[str]:
    """Pieces between blanks and line feeds; no word or composition spans one."""
    return text.replace("\n", " ").split(" ")


class FinishedWords:
    """Ids of the words met so far, kept from batch to batch, so only new words enter a pair index.

    Beyond ``most`` words it starts anew with the next batch.
    """

    def __init__(self, vocabulary: Vocabulary, most: int = MOST_WORDS):
        self.vocabulary, self.most = vocabulary, most
        self._clear()

    def _clear(self) -> None:
        self.number = numbers()
        self.number["\n"]
        self.ids = Lists(np.zeros(0, np.int32), np.zeros(1, np.int64))

    def open(self) -> defaultdict:
        """Numbers of words for one batch; 0 is the break between stretches."""
        if len(self.number) > self.most:
            self._clear()
        return self.number

    def finish(self) -> Lists:
        """Ids of all numbered words, word 1 first."""
        done = len(self.ids.bounds) - 1
        new = list(islice(self.number, done + 1, None))
        if new:
            index = PairIndex(self.vocabulary, new)
            index.merge_all()
            more = index.tokens()
            bounds = np.append(self.ids.bounds, self.ids.bounds[-1] + more.bounds[1:])
            self.ids = Lists(np.concatenate([self.ids.flat, more.flat]), bounds)
        return self.ids


def encode_batch(vocabulary: Vocabulary, texts: list[str], finished: FinishedWords | None = None) -> Iterator[np.ndarray]:
    """Ids of each text.  Distinct stretches of the batch and words not finished before are handled once."""
    finished = finished or FinishedWords(vocabulary)
    stretch_no, word_no, codes = numbers(), finished.open(), []
    for text in texts:
        if vocabulary.is_odd(text):
            codes.append([w if isinstance(w, int) else -1 - word_no[w] for w in vocabulary.words(text)])
        else:
            parts = stretches(text)
            codes.append(np.fromiter(map(stretch_no.__getitem__, parts), np.int32, len(parts)))
    low = vocabulary.lowered("\n".join(stretch_no)) + "\n"
    found = vocabulary.word_or_break.findall(low)
    flat = np.fromiter(map(word_no.__getitem__, found), np.int32, len(found))
    del found, low
    breaks = np.flatnonzero(flat == 0)
    # words of each stretch, without the breaks
    in_stretch = Lists(flat[flat != 0] - 1, np.append(0, breaks - np.arange(len(breaks))))
    of_word = finished.finish()
    ids_flat, ends = of_word.strung(in_stretch.flat)
    of_stretch = Lists(ids_flat, ends[in_stretch.bounds])
    for text_codes in codes:
        if isinstance(text_codes, list):  # special tokens among the words
            parts = [[c] if c >= 0 else of_word.strung(np.array([-2 - c]))[0] for c in text_codes]
            yield np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int32)
        else:
            yield of_stretch.strung(text_codes)[0]


def id_lists(parts: list[np.ndarray]) -> pa.ListArray:
    bounds = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([*parts, np.zeros(0, np.int32)])))


def token_table(path: str) -> np.ndarray:
    """Token of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    named = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return np.array([named.get(i) for i in range(max(named) + 1)], object)


def decode_ids(table: np.ndarray, ids: np.ndarray) -> str:
    """Tokens joined by blanks; the file names no decoder.  Ids without a token decode to nothing."""
    known = ids[(ids >= 0) & (ids < len(table))]
    return " ".join([t for t in table[known].tolist() if t is not None])


def _mapped(docs: DataFrame, source: DataFrame, new: dict[str, T.DataType], work) -> DataFrame:  # noqa: ANN001
    """``work(batch)`` gives the new columns for the last column of ``source``; the others stay."""
    kept = [f for f in docs.schema.fields if f.name in source.columns[:-1]]
    names = [*[f.name for f in kept], *new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = None
        for small in in_portions(batches, source_width, BYTES_AT_ONCE):
            give_back()
            columns = columns or work()
            yield pa.RecordBatch.from_arrays([*small.columns[:-1], *columns(small.column(source_width))], names)

    source_width = len(source.columns) - 1
    return source.mapInArrow(run, T.StructType([*kept, *[T.StructField(n, t) for n, t in new.items()]]))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` without the text, with ``ids`` array<int>: the whole text, no special tokens added.

    ``decoded`` names a column for the decoded ids, made in the same pass.
    """
    new: dict[str, T.DataType] = {ids: T.ArrayType(T.IntegerType())} | ({decoded: T.StringType()} if decoded else {})

    def work():  # noqa: ANN202
        vocabulary = Vocabulary(path)
        finished = FinishedWords(vocabulary)
        table = token_table(path) if decoded else None

        def columns(texts: pa.Array) -> list[pa.Array]:
            found = list(encode_batch(vocabulary, texts.to_pylist(), finished))
            lists = [id_lists(found)]
            return lists if table is None else [*lists, pa.array([decode_ids(table, x) for x in found], pa.string())]

        return columns

    kept = [c for c in docs.columns if c != text and c not in new]
    return _mapped(docs, docs.select(*kept, filled(text).alias("_text")), new, work)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with ``text``: the tokens of ``ids`` joined by blanks, special tokens included."""
    kept = [f for f in docs.schema.fields if f.name != text]
    at = [f.name for f in kept].index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                small = batch.slice(start, 500)
                rows = [x.values.to_numpy(zero_copy_only=False).astype(np.int64) if x.is_valid else np.zeros(0, np.int64) for x in small.column(at)]
                decoded = pa.array([decode_ids(table, x) for x in rows], pa.string())
                yield pa.RecordBatch.from_arrays([*small.columns, decoded], [*[f.name for f in kept], text])

    return docs.select(*[f.name for f in kept]).mapInArrow(run, T.StructType([*kept, T.StructField(text, T.StringType())]))
