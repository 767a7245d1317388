"""Byte-level BPE encoding and decoding (operator 7).

Encoding is a tree reduction over a monoid: the elements are token lists, and
the product of two neighbours is the token list of their joined bytes. A
piece of text is halved until its parts are short, the parts are merged
directly, and neighbours are joined by encoding again a window around the
boundary. The window grows until the tokens outside it are proved to be
those of the whole.

The proof: greedy merging by rank treats a stretch of bytes alike whether it
stands alone or inside a text, as long as no merge crosses its ends. So a
list of tokens is the encoding of its bytes exactly if each neighbouring pair
``(a, b)``, encoded alone, gives ``[a, b]`` again (the first merge across a
boundary would have to happen in that pair, too). Inside the left list, the
window and the right list this holds by construction; the two pairs at the
window's ends are what :meth:`Bpe.join` tests.

Texts are first cut by the tokenizer's pattern; a match that is itself in the
vocabulary is one token, as in the public library. The distinct matches of a
batch go up the tree together: leaves of ``LEAF`` bytes are merged as rows of
one matrix, equal ones once, and each level joins all its neighbours at once:
as they are where the two tokens that meet prove it, else with windows that
grow for the rows whose ends are not proved yet. Matches of more than ``SHORT``
bytes go up the tree one by one. Decoding concatenates the tokens' bytes up a
tree of halves.

What a process has encoded it remembers in tables of fixed size, compared by all
bytes: short matches with their tokens, nodes and windows of up to ``NODE`` bytes, and
pairs. So only what earlier batches did not have, or what later rows displaced, is
merged. A batch of new words costs little more than without the tables.

Defined results: null is encoded as the empty text (no tokens, empty bytes);
very long texts and very long matches are encoded whole; rows are
independent, so repeated rows give equal ids, and extra columns of any name
are left alone. Ids are held as one binary per text, little-endian unsigned
32 bit, which no engine has to convert.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm import common
from aerolap.llm.common import released, trim

#: Vocabularies are fixed files of about 1 MB; a larger one is refused as broadcast.
MAX_VOCABULARY_BYTES = 64 * 1024 * 1024
#: Bytes of a leaf of the tree over a match that is joined as rows of matrices.
LEAF = 4
#: Matches up to this many bytes are joined so; it is also the leaf of longer ones.
SHORT = 32
REMEMBERED_PAIRS = 200_000
#: Bytes of a node or window that is remembered, and most tokens of a match that is.
NODE = 8
#: How many matches, and nodes and windows, are remembered, of 57 and 33 bytes each with
#: ids of up to 16 bits, else of 73 and 49.
REMEMBERED_MATCHES = 3 << 17
REMEMBERED_NODES = 1 << 18
#: Ids in a leaf of the tree that decodes.
DECODED = 256


def unicode_space(pattern: str) -> str:
    """The pattern with ``\\s`` as Unicode White_Space (the module's own ``\\s`` has more)."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


_NONE = np.int32((1 << 31) - 1)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)  # to mix bits with
_EMPTY = pa.scalar("", pa.large_string())
_MARKS = ".,;:!?"
#: A blank or line end at an end of the text or beside white space (RE2).
_SPACE = "[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x{85}]"
_CANNOT_CUT = f"^[ \\n]|[ \\n]$|{_SPACE}[ \\n]|\\n{_SPACE}"
#: A word of letters, perhaps with one mark, as the pattern cuts it: each group is one match.
_SIMPLE = "^(?P<nl>\\n?)(?P<main> ?\\p{L}+)(?P<mark>[.,;:!?]?)$"
_BATCH = 2 << 20  # bytes of text handled together


def text_slices(texts: pa.Array):
    """Neighbouring texts of together about ``_BATCH`` bytes."""
    return common.text_slices(texts, _BATCH)


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values and bounds of an Arrow list array."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]


def _binary(bounds: np.ndarray, data) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)])


def _joined(parts: pa.Array, place: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Concatenations of ``parts[place[a:b]]`` for neighbouring bounds a, b."""
    taken = parts.take(pa.array(place))
    at = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
    return _binary(at[bounds], taken.buffers()[2] if taken.buffers()[2] is not None else b"")


class Decoder:
    """Bytes of packed ids: only the tokens' bytes, none of the encoder's tables."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {i: b for b, i in ranks.items()}

    def decode(self, packed: bytes | None) -> bytes:
        """Concatenation up a tree of halves."""
        ids = np.frombuffer(packed or b"", "<u4")
        if len(ids) <= DECODED:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        mid = len(ids) // 2
        return self.decode(ids[:mid].tobytes()) + self.decode(ids[mid:].tobytes())


class Bpe(Decoder):
    """Encoder and decoder over one vocabulary, for use inside a task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__(ranks)
        self.ranks = ranks
        self._packed_id = {i: i.to_bytes(4, "little") for i in ranks.values()}
        self._byte_ids = np.array([ranks[bytes((x,))] for x in range(256)], np.int32)
        # ids of up to 16 bits take half the place
        kind = np.uint16 if max(ranks.values()) < 1 << 16 else np.int32
        self._matches = _Seen(SHORT // 8 + 1, REMEMBERED_MATCHES, kind)
        self._nodes = _Seen(NODE // 8 + 1, REMEMBERED_NODES, kind)
        # (left id, right id) -> id of their concatenation, for every split of every token
        merges = sorted((ranks[t[:k]] << 32 | ranks[t[k:]], i) for t, i in ranks.items()
                        for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
        self._merges = dict(merges)
        self._keys = np.array([k for k, _ in merges], np.int64)
        self._merged = np.array([i for _, i in merges], np.int32)
        self._byte_pairs = self._rank_of(
            np.repeat(self._byte_ids, 256), np.tile(self._byte_ids, 256)).reshape(256, 256)
        self._find = regex.compile(unicode_space(pattern)).findall
        self._whole_only = None
        tokens = pa.array([t for t in ranks if len(t) <= SHORT], pa.large_binary())
        made = pc.binary_length(self.merge_many(tokens)).to_numpy() != 4
        if made.any():
            self._whole_only = tokens.filter(pa.array(made))
        self._stable: dict[int, bool] = {}
        self._pair_keys = np.full(REMEMBERED_PAIRS, -1, np.int64)
        self._pair_stable = np.zeros(REMEMBERED_PAIRS, bool)
        self._size = np.zeros(max(self.bytes_of) + 1, np.int64)
        self._size[list(self.bytes_of)] = [len(t) for t in self.bytes_of.values()]
        self.joins = 0  # of neighbours, so far; equal ones joined at once count each

    def forget(self) -> None:
        """Drop the matches and nodes that were remembered."""
        self._matches.forget()
        self._nodes.forget()

    # --- the monoid -------------------------------------------------------

    def merge(self, b: bytes) -> list[int]:
        """Token ids by direct greedy merging (lowest rank, leftmost first)."""
        if len(b) > 2 * SHORT:
            return self._merge_long(b)
        get, none = self._merges.get, 1 << 62
        ids = [int(self._byte_ids[x]) for x in b]
        pairs = [get(x << 32 | y, none) for x, y in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) != none:
            i = pairs.index(best)  # a merged token's rank is its id
            ids[i] = best
            del ids[i + 1], pairs[i]
            if i:
                pairs[i - 1] = get(ids[i - 1] << 32 | best, none)
            if i < len(pairs):
                pairs[i] = get(best << 32 | ids[i + 1], none)
        return ids

    def _merge_long(self, b: bytes) -> list[int]:
        """The same with a heap: n log n for long windows."""
        n, ranks = len(b), self.ranks
        part: list[bytes | None] = [b[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := ranks.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (r, i, len(part[i]), len(part[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, c = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or len(part[i]) != a or len(part[j]) != c:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[p] for p in part if p is not None]

    def _pair_is_stable(self, a: int, b: int) -> bool:
        known = self._stable.get(a << 32 | b)
        if known is None:
            if len(self._stable) > REMEMBERED_PAIRS:
                self._stable.clear()
            known = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self._stable[a << 32 | b] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the joined bytes of two encoded neighbours."""
        if not left or not right:
            return left or right
        self.joins += 1
        i, j = min(2, len(left)), min(2, len(right))
        while True:
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[-i:] + right[:j])))
            left_holds = i == len(left) or self._pair_is_stable(left[-i - 1], window[0])
            right_holds = j == len(right) or self._pair_is_stable(window[-1], right[j])
            if left_holds and right_holds:
                return left[:-i] + window + right[j:]
            if not left_holds:
                i = min(2 * i, len(left))
            if not right_holds:
                j = min(2 * j, len(right))

    def reduce(self, b: bytes) -> list[int]:
        """Halve, encode the halves, join."""
        if len(b) <= SHORT:
            return self.merge(b)
        mid = len(b) // 2
        return self.join(self.reduce(b[:mid]), self.reduce(b[mid:]))

    # --- texts ------------------------------------------------------------

    def piece(self, b: bytes) -> list[int]:
        whole = self.ranks.get(b)
        return [whole] if whole is not None else self.reduce(b)

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Packed ids of one text."""
        return b"".join(self._pack(self.piece(p.encode("utf-8", "surrogatepass")))
                        for p in self._find(text or ""))

    def encode_batch(self, texts: pa.Array) -> pa.Array:
        """Packed ids of many texts.

        A match of the pattern never goes on from a visible character to a
        blank or a line end, so a text may be cut before each of those that
        stands between visible characters. Arrow cuts the texts and finds the
        distinct words; each is encoded once, and the texts are put together
        from them. Texts with other white space go whole.
        """
        parts = [self._encode_part(texts.slice(at, n).cast(pa.large_string()).fill_null(_EMPTY))
                 for at, n in text_slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    def _encode_part(self, texts: pa.Array) -> pa.Array:
        whole = pc.match_substring_regex(texts, _CANNOT_CUT)
        lines, line_ends = _flat(pc.split_pattern(pc.if_else(whole, _EMPTY, texts), "\n"))
        words, word_ends = _flat(pc.split_pattern(lines, " "))
        # what a word follows: nothing, a line end, or a blank
        lead = np.full(len(words), 2, np.int8)
        lead[word_ends[:-1]] = 1
        lead[word_ends[line_ends[:-1]]] = 0
        leads = pa.array(["", "\n", " "], pa.large_string()).take(pa.array(lead))
        keys = pc.binary_join_element_wise(leads, words, _EMPTY).dictionary_encode()
        place = keys.indices.to_numpy().astype(np.int64)
        ends = word_ends[line_ends]
        distinct = self._keys_packed(keys.dictionary)
        odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if len(odd):  # such a text was cut to one empty word
            place[ends[odd]] = len(distinct) + np.arange(len(odd))
            distinct = pa.concat_arrays([distinct, self._found_packed(
                texts.take(pa.array(odd)).to_pylist())])
        return _joined(distinct, place, ends).cast(pa.binary())

    def _keys_packed(self, keys: pa.Array) -> pa.Array:
        """Packed ids of distinct words with their leads."""
        parts = pc.extract_regex(keys, _SIMPLE)
        simple = parts.is_valid().to_numpy(zero_copy_only=False)
        nl, main, mark = (pc.struct_field(parts, i).fill_null(_EMPTY) for i in range(3))
        mains = main.dictionary_encode()
        rest = np.flatnonzero(~simple)
        pieces = pa.concat_arrays([
            self._strings_packed(mains.dictionary),
            self._strings_packed(pa.array(["", "\n", *_MARKS], pa.large_string())),
            self._found_packed(keys.take(pa.array(rest)).to_pylist())])
        fixed = len(mains.dictionary)
        place = np.full((len(keys), 3), fixed, np.int64)  # of "", which is no token
        place[:, 0] += pc.equal(nl, pa.scalar("\n", pa.large_string())).to_numpy(zero_copy_only=False)
        place[:, 1] = mains.indices.to_numpy()
        place[:, 2] = fixed + 2 + pc.fill_null(
            pc.index_in(mark, pa.array(list(_MARKS), pa.large_string())), -2).to_numpy()
        place[rest] = fixed
        place[rest, 1] = fixed + 2 + len(_MARKS) + np.arange(len(rest))
        return _joined(pieces, place.ravel(), np.arange(len(keys) + 1) * 3)

    def _found_packed(self, texts: list[str]) -> pa.Array:
        """Packed ids of texts that the pattern itself has to cut."""
        found = [self._find(t) for t in texts]
        ends = np.cumsum([0, *map(len, found)])
        pieces = pa.array([p for ps in found for p in ps], pa.large_string()).dictionary_encode()
        return _joined(self._strings_packed(pieces.dictionary),
                       pieces.indices.to_numpy().astype(np.int64), ends)

    def _strings_packed(self, strings: pa.Array) -> pa.Array:
        """Packed ids of distinct matches: short ones of earlier batches are remembered."""
        short = np.flatnonzero(pc.binary_length(strings).to_numpy() <= SHORT)
        rows = _wide_rows(*_byte_rows(strings.take(pa.array(short))), SHORT)
        hit, tokens, length = self._matches.get(rows)
        known = np.zeros(len(strings), bool)
        known[short[hit]] = True
        made = self._new_packed(strings.filter(pa.array(~known)))
        fresh = (np.cumsum(~known) - 1)[short[~hit]]  # which of the made ones are short
        self._remember(rows[~hit], made.take(pa.array(fresh)))
        where = np.empty(len(strings), np.int64)
        where[known] = np.arange(len(strings) - len(made))
        where[~known] = len(strings) - len(made) + np.arange(len(made))
        return pa.concat_arrays([_packed(tokens[hit], length[hit]), made]).take(pa.array(where))

    def _remember(self, rows: np.ndarray, packed: pa.Array) -> None:
        """Short matches of up to ``NODE`` tokens are known from now on."""
        raw, n = _byte_rows(packed)
        few = np.flatnonzero(n <= 4 * NODE)
        ids = np.zeros((len(few), 4 * NODE), np.uint8)
        k = min(ids.shape[1], raw.shape[1])
        ids[:, :k] = raw[few, :k]
        self._matches.put(rows[few], ids.view("<u4").astype(np.int32), n[few] // 4)

    def _new_packed(self, strings: pa.Array) -> pa.Array:
        """Packed ids of distinct matches: short ones go up the tree together."""
        size = pc.binary_length(strings).to_numpy()
        short = np.argsort(size, kind="stable")[:int((size <= SHORT).sum())]  # alike in width
        out, order = [], [short]
        for at in range(0, len(short), 1 << 15):
            out.append(self.reduce_many(strings.take(pa.array(short[at:at + (1 << 15)]))))
        # long matches, and tokens that merging does not make
        other = {i: self._pack(self.piece(strings[i].as_py().encode("utf-8", "surrogatepass")))
                 for i in np.flatnonzero(size > SHORT).tolist()}
        if self._whole_only is not None:
            hit = pc.is_in(strings.cast(pa.large_binary()), self._whole_only)
            other |= {i: self._packed_id[self.ranks[strings[i].as_py().encode()]]
                      for i in np.flatnonzero(hit.to_numpy(zero_copy_only=False)).tolist()}
        order.append(np.array(list(other), np.int64))
        out.append(pa.array(other.values(), pa.large_binary()))
        where = np.empty(len(strings), np.int64)
        order = np.concatenate(order)
        where[order] = np.arange(len(order))
        return pa.concat_arrays(out).take(pa.array(where))

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's concatenation, ``_NONE`` if that is no token."""
        key = a.astype(np.int64) << 32 | b
        i = np.searchsorted(self._keys, key)
        i[i == len(self._keys)] = 0
        return np.where(self._keys[i] == key, self._merged[i], _NONE)

    def merge_many(self, strings: pa.Array) -> pa.Array:
        """:meth:`merge` of many short strings at once, packed."""
        return _packed(*self._merge_rows(*_byte_rows(strings)))

    def _merge_rows(self, raw: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`merge` of the first ``n`` bytes of every row: a matrix of tokens, and the
        rows' lengths. Rows of up to ``NODE`` bytes are remembered."""
        long = np.flatnonzero(n > NODE)
        if not len(long):
            return self._remembered(raw, n, lambda new: self._merge_new_rows(raw[new], n[new]))
        tokens, length = np.zeros((len(n), raw.shape[1]), np.int32), np.zeros_like(n)
        tokens[long], length[long] = self._merge_new_rows(raw[long], n[long])
        if len(rows := np.flatnonzero(n <= NODE)):
            tokens[rows, :NODE], length[rows] = self._merge_rows(raw[rows, :NODE], n[rows])
        return tokens, length

    def _merge_new_rows(self, raw: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A matrix of which every row takes its next merge in each step."""
        cols = np.arange(raw.shape[1])
        tokens = self._byte_ids[raw]
        ranks = np.where(cols[1:] < n[:, None], self._byte_pairs[raw[:, :-1], raw[:, 1:]], _NONE)
        done, length = tokens.copy(), n.copy()
        rows = np.flatnonzero(n > 1)
        tokens, ranks, n = tokens[rows], ranks[rows], n[rows]
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            go = best != _NONE
            if not go.all():
                done[rows[~go]], length[rows[~go]] = tokens[~go], n[~go]
                rows, tokens, ranks, n = rows[go], tokens[go], ranks[go], n[go]
                at, best = at[go], best[go]
                if not len(rows):
                    break
            i = np.arange(len(rows))
            after = cols >= at[:, None]
            tokens[:, :-1] = np.where(after[:, :-1], tokens[:, 1:], tokens[:, :-1])
            tokens[i, at] = best
            ranks[:, :-1] = np.where(after[:, :-2], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = _NONE
            n = n - 1
            left = at > 0
            ranks[i[left], at[left] - 1] = self._rank_of(tokens[i[left], at[left] - 1], best[left])
            right = at + 1 < n
            ranks[i[right], at[right]] = self._rank_of(best[right], tokens[i[right], at[right] + 1])
            ranks[i[~right], at[~right]] = _NONE
        return done, length

    def reduce_many(self, strings: pa.Array) -> pa.Array:
        """:meth:`reduce` of many short strings at once, packed: a row for each node of a
        level, and all neighbours of a level joined together."""
        raw, n = _byte_rows(strings)
        parts, width = 1, LEAF
        while parts * width < n.max(initial=0):
            parts *= 2
        raw = np.ascontiguousarray(
            np.pad(raw, ((0, 0), (0, max(0, parts * width - raw.shape[1]))))[:, :parts * width])
        sizes = np.clip(n[:, None] - width * np.arange(parts), 0, width).ravel()
        # matches share many leaves, and pairs of leaves: each is merged or joined once
        first, place = _distinct(raw.reshape(-1, width), sizes)
        tokens, length = (x[place] for x in self._merge_rows(raw.reshape(-1, width)[first], sizes[first]))
        while parts > 1:
            parts, width, sizes = parts // 2, width * 2, sizes[::2] + sizes[1::2]
            self.joins += np.count_nonzero(length[1::2])
            nodes = raw.reshape(-1, width)
            first, place = _distinct(nodes, sizes) if width <= 8 else (slice(None), slice(None))
            tokens, length = (x[place] for x in self._join_rows(
                nodes[first], tokens[::2][first], length[::2][first], tokens[1::2][first],
                length[1::2][first]))
        return _packed(tokens, length)

    def _join_rows(self, raw: np.ndarray, left: np.ndarray, n_left: np.ndarray,
                   right: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`join` of neighbours in every row; ``raw`` has the bytes of both, which
        meet in its middle. Nodes of up to ``NODE`` bytes are remembered."""
        if raw.shape[1] > NODE:
            return self._join_new_rows(raw, left, n_left, right, n_right)
        size = self._bytes_in(left, n_left) + self._bytes_in(right, n_right)
        return self._remembered(raw, size, lambda new: self._join_new_rows(
            raw[new], left[new], n_left[new], right[new], n_right[new]))

    def _bytes_in(self, tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.arange(tokens.shape[1]) < n[:, None], self._size[tokens], 0).sum(1)

    def _remembered(self, raw: np.ndarray, n: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the first ``n`` bytes of every row, at most ``NODE``, and their number;
        ``encode`` gives those of rows that are not known, each distinct one once."""
        rows = _wide_rows(raw, n, NODE)
        known, tokens, length = self._nodes.get(rows)
        if len(new := np.flatnonzero(~known)):
            first, place = _distinct(rows[new, :-1].copy().view(np.uint8), n[new])
            first = new[first]
            made, count = encode(first)
            fresh = np.zeros((len(first), NODE), np.int32)
            k = min(NODE, made.shape[1])
            fresh[:, :k] = made[:, :k]
            tokens[new], length[new] = fresh[place], count[place]
            self._nodes.put(rows[first], fresh, count)
        return tokens[:, :raw.shape[1]], length

    def _join_new_rows(self, raw: np.ndarray, left: np.ndarray, n_left: np.ndarray,
                       right: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = left.shape[1]
        cols, wide = np.arange(half), np.arange(2 * half)
        out, length = np.pad(left, ((0, 0), (0, half))), n_left.copy()
        rows = np.flatnonzero(n_right)  # where there is a right part, the left one is full
        # two tokens that merging leaves apart already prove the join, without a window
        apart = self._pairs_are_stable(left[rows, n_left[rows] - 1], right[rows, 0])
        as_is, rows = rows[apart], rows[~apart]
        k = n_left[as_is, None]
        out[as_is] = np.where(wide < k, out[as_is], np.take_along_axis(
            right[as_is], np.clip(wide - k, 0, half - 1), 1))
        length[as_is] = n_left[as_is] + n_right[as_is]
        i, j = np.minimum(2, n_left[rows]), np.minimum(2, n_right[rows])
        while len(rows):
            a, b, n_a, n_b = left[rows], right[rows], n_left[rows], n_right[rows]
            kept = n_a - i
            inside = (cols >= kept[:, None]) & (cols < n_a[:, None])
            before = np.where(inside, self._size[a], 0).sum(1)
            size = before + np.where(cols < j[:, None], self._size[b], 0).sum(1)
            at = (half - before)[:, None] + np.arange(int(size.max()))
            window, n = self._merge_rows(
                np.take_along_axis(raw[rows], np.minimum(at, 2 * half - 1), 1), size)
            every = np.arange(len(rows))
            left_holds, right_holds = kept == 0, j == n_b
            test = np.flatnonzero(~left_holds)
            left_holds[test] = self._pairs_are_stable(a[test, kept[test] - 1], window[test, 0])
            test = np.flatnonzero(~right_holds)
            right_holds[test] = self._pairs_are_stable(
                window[every, n - 1][test], b[test, j[test]])
            holds = left_holds & right_holds
            k, m = kept[holds, None], n[holds, None]
            out[rows[holds]] = np.where(wide < k, np.pad(a[holds], ((0, 0), (0, half))), np.where(
                wide < k + m,
                np.take_along_axis(window[holds], np.clip(wide - k, 0, window.shape[1] - 1), 1),
                np.take_along_axis(b[holds], np.clip(wide - k - m + j[holds, None], 0, half - 1), 1)))
            length[rows[holds]] = (kept + n + n_b - j)[holds]
            i = np.where(left_holds, i, np.minimum(2 * i, n_a))[~holds]
            j = np.where(right_holds, j, np.minimum(2 * j, n_b))[~holds]
            rows = rows[~holds]
        return out, length

    def _pairs_are_stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`_pair_is_stable` of many pairs. Unknown ones are merged as one matrix and
        remembered, each at one place, where a later one may follow."""
        keys = a.astype(np.int64) << 32 | b
        at = self._pair_places(keys)
        stable, new = self._pair_stable[at], np.flatnonzero(self._pair_keys[at] != keys)
        if len(new):
            keys, place = np.unique(keys[new], return_inverse=True)
            first, second = keys >> 32, keys & 0xFFFFFFFF
            tokens, n = self._merge_rows(*_byte_rows(pa.array(
                [self.bytes_of[x] + self.bytes_of[y]
                 for x, y in zip(first.tolist(), second.tolist())], pa.large_binary())))
            made = (n == 2) & (tokens[:, 0] == first) & (tokens[:, 1] == second)
            stable[new] = made[place]
            at, one = np.unique(self._pair_places(keys), return_index=True)
            self._pair_keys[at], self._pair_stable[at] = keys[one], made[one]
        return stable

    def _pair_places(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * _ODD[0] >> np.uint64(32)
        return (mixed % np.uint64(len(self._pair_keys))).astype(np.int64)


def _byte_rows(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The strings' bytes as rows of a matrix, and their lengths."""
    n = pc.binary_length(strings).to_numpy().astype(np.int64)
    raw = np.zeros((len(n), int(n.max(initial=0)) + 1), np.uint8)
    data = strings.cast(pa.large_binary())
    first, last = (np.frombuffer(data.buffers()[1], np.int64)[data.offset + i]
                   for i in (0, len(data))) if len(data) else (0, 0)
    if last > first:
        raw[np.arange(raw.shape[1]) < n[:, None]] = np.frombuffer(
            data.buffers()[2], np.uint8)[first:last]
    return raw, n


def _wide_rows(raw: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
    """Rows of bytes as rows of numbers: up to ``width`` bytes, of which ``n`` count, and
    then ``n``."""
    wide = np.zeros((len(n), width + 8), np.uint8)
    k = min(width, raw.shape[1])
    wide[:, :k] = np.where(np.arange(k) < n[:, None], raw[:, :k], 0)
    rows = wide.view(np.uint64)
    rows[:, -1] = n
    return rows


class _Seen:
    """Tokens of byte rows (see :func:`_wide_rows`) that were encoded before, ``limit`` at
    most: a row's hash is its place, and a later row takes it over. A row is known only if
    all its bytes are those at its place. Unused places have the empty row, which is right."""

    def __init__(self, columns: int, limit: int, kind: type = np.int32):
        self._columns, self._limit, self._kind = columns, limit, kind
        self.forget()

    def forget(self) -> None:
        """Drop the tables; they are made again, empty, when needed."""
        self._rows = self._tokens = self._length = None

    def _ready(self) -> None:
        if self._rows is None:
            self._rows = np.zeros((self._limit, self._columns), np.uint64)
            self._tokens = np.zeros((self._limit, NODE), self._kind)
            self._length = np.zeros(self._limit, np.int8)

    def places(self, rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1]):
            h = (h ^ rows[:, k]) * _ODD[k]
            h ^= h >> np.uint64(29)
        return ((h >> np.uint64(32)) % np.uint64(self._limit)).astype(np.int64)

    def get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which rows are known, and for every row tokens and length, right for those."""
        self._ready()
        at = self.places(rows)
        known = np.ones(len(rows), bool)
        for k in range(rows.shape[1]):
            known &= self._rows[at, k] == rows[:, k]
        return known, self._tokens[at].astype(np.int32), self._length[at].astype(np.int64)

    def put(self, rows: np.ndarray, tokens: np.ndarray, length: np.ndarray) -> None:
        self._ready()
        at, first = np.unique(self.places(rows), return_index=True)
        self._rows[at], self._tokens[at], self._length[at] = rows[first], tokens[first], length[first]


def _distinct(raw: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row of up to 8 bytes, of which ``n`` count, stands first, and
    which of these every row equals. Bytes that do not count are 0."""
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :raw.shape[1]] = raw
    key = wide.view(np.uint64).ravel()
    # equal bytes of unequal length differ in trailing zero bytes: lengths are told apart, too
    order = np.lexsort((n, key)) if (raw == 0).any() else key.argsort()
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (n[order][1:] != n[order][:-1])
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def _packed(tokens: np.ndarray, length: np.ndarray) -> pa.Array:
    """The first ``length`` ids of each row as one binary."""
    ids = tokens[np.arange(tokens.shape[1]) < length[:, None]].astype("<u4")
    return _binary(4 * np.cumsum([0, *length]), ids.tobytes())


_loaded: dict[tuple, Decoder] = {}


class Vocabulary:
    """A rank file shipped to the tasks as a broadcast of checked size."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            data = f.read(MAX_VOCABULARY_BYTES + 1)
        if len(data) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"vocabulary larger than {MAX_VOCABULARY_BYTES} bytes: {path}")
        self._data = spark.sparkContext.broadcast(data)
        self._key = f"{path}:{len(data)}:{pattern}"
        self._pattern = pattern

    def _ranks(self) -> dict[bytes, int]:
        return {base64.b64decode(t): int(r)
                for t, r in map(bytes.split, self._data.value.splitlines())}

    def bpe(self) -> Bpe:
        """The encoder, built once per Python process."""
        key = (self._key, "bpe")
        if key not in _loaded:
            _loaded[key] = Bpe(self._ranks(), self._pattern)
        return _loaded[key]

    def decoder(self) -> Decoder:
        """The decoder, built once per Python process."""
        key = (self._key, "decoder")
        if key not in _loaded:
            _loaded[key] = Decoder(self._ranks())
        return _loaded[key]


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """Bytes of a column of packed ids."""
    @F.arrow_udf(T.BinaryType())
    def run(values: pa.Array) -> pa.Array:
        one = vocabulary.decoder().decode
        return pa.array((one(v.as_py()) for v in values), pa.binary())

    return run(ids)


DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType())])


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text",
                     out: str | None = "ids", decoded: str | None = None,
                     digests: bool = False) -> DataFrame:
    """``docs`` with the text replaced by its packed ids, as column ``out`` at the end.

    With ``decoded``, a further column of that name holds the bytes that the ids
    decode to. With ``digests``, the columns of :data:`DIGESTS` follow: the number
    of ids, and the SHA-256 of the packed ids and of the bytes they decode to,
    taken in the worker, so that neither has to leave it (``out`` may be None then).
    This is a step of its own in the plan (not a column function), so that no
    later expression makes Spark encode a text twice.
    """
    made = [*([out] if out else []), *([decoded] if decoded else [])]
    kept = [*made, *(DIGESTS.names if digests else [])]
    others = [c for c in docs.columns if c not in (text_col, *kept)]
    names = [*others, *kept]

    def columns_of(bpe: Bpe, part: pa.RecordBatch) -> list:
        packed = bpe.encode_batch(part.column(len(others)))
        columns = [*part.columns[:-1], *([packed] if out else [])]
        texts: list[bytes] = []
        marks: tuple[list, list, list] = ([], [], [])
        for x in packed if decoded or digests else ():
            ids = x.as_py()
            text = bpe.decode(ids)
            if decoded:
                texts.append(text)
            if digests:
                marks[0].append(len(ids) // 4)
                marks[1].append(hashlib.sha256(ids).hexdigest())
                marks[2].append(hashlib.sha256(text).hexdigest())
        if decoded:
            columns.append(pa.array(texts, pa.binary()))
        if digests:
            columns += [pa.array(m, t) for m, t in zip(marks, (pa.int64(), pa.string(), pa.string()))]
        return columns

    def run(batches):
        bpe = vocabulary.bpe()
        try:
            for batch in batches:
                for at, n in text_slices(batch.column(batch.num_columns - 1)):
                    yield pa.RecordBatch.from_arrays(columns_of(bpe, batch.slice(at, n)), names)
                    trim()
        finally:
            bpe.forget()  # the process outlives the task, beside other tasks' processes

    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text_col}`"))
    schema = T.StructType([*rows.schema.fields[:-1],
                           *[T.StructField(c, T.BinaryType()) for c in made],
                           *(DIGESTS.fields if digests else [])])
    return rows.mapInArrow(released(run), schema)


def token_ids(packed: bytes) -> list[int]:
    """The ids in a packed binary, as a list."""
    return np.frombuffer(packed, "<u4").tolist()
