"""Byte-level BPE by dynamic programming over prefixes.

The merges of a vocabulary decide, for every prefix of a piece, one last token: the one that
ends the encoding of that prefix. So an encoding is a chain: the last token of the whole, then
the last token of what is before it, and so on. The table of last tokens is filled from
left to right; a token may end a prefix if it fits behind the last token of the shorter
prefix, which depends on those two tokens alone. An entry depends on the bytes before it only,
so a piece can be appended to, or changed in the middle, without encoding its beginning again.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from docloom.llm.texts import Chunk, chunks, same_bytes, span_hashes

#: Name of the vocabulary's rank file, and the pattern that cuts a text into pieces.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PATTERN = public_tokenizers.PATTERN
#: Pieces whose ids a worker remembers.
REMEMBERED = 2_000_000
#: Pieces of up to so many bytes are encoded side by side and remembered.
SIDE_BY_SIDE = 64


class Vocabulary:
    """Tokens of a rank file, with the two parts that each was merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        #: Rank at which a token comes into being; single bytes are there from the start.
        self.born: dict[int, int] = {}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        #: Tokens that merging can produce. Others encode only a piece equal to them.
        self.reachable: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(token) == 1:
                self.born[rank] = -1
                self.reachable[token] = rank
                continue
            parts = self.merged(token, rank)
            if len(parts) == 2:
                self.born[rank] = rank
                self.left[rank], self.right[rank] = parts
                self.reachable[token] = rank
        self.fitting: dict[int, bool] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def merged(self, piece: bytes, below: int) -> list[int]:
        """What plain merging makes of a short piece with merges of ranks under ``below``."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, below) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best >= below:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def fits(self, first: int, second: int) -> bool:
        """Merging leaves the boundary between these neighbours alone.

        Undo the later of the two merges at the boundary, again and again; a merge across
        it that comes before the one just undone would have been made.
        """
        key = first << 32 | second
        known = self.fitting.get(key)
        if known is not None:
            return known
        tokens, ranks, born = self.tokens, self.ranks, self.born
        x, y, limit, good = first, second, 1 << 62, True
        while True:
            across = ranks.get(tokens[x] + tokens[y])
            if across is not None and across < limit:
                good = False
                break
            bx, by = born[x], born[y]
            if bx < 0 and by < 0:
                break
            if bx > by:
                limit, x = bx, self.right[x]
            else:
                # of two equal merges the left one, which is the one across, comes first
                limit, y = by + 1, self.left[y]
        if len(self.fitting) > 1_000_000:
            self.fitting.clear()
        self.fitting[key] = good
        return good


class PrefixTable:
    """The last token of every prefix of one piece, kept up to date under edits."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last = array("i", [-1])
        self.append(piece)

    def _end(self, piece: bytes, end: int) -> int:
        """The token that ends the encoding of ``piece[:end]``."""
        reachable, last, fits = self.vocabulary.reachable, self.last, self.vocabulary.fits
        for start in range(max(0, end - self.vocabulary.longest), end):
            token = reachable.get(piece[start:end])
            if token is not None and (not start or fits(last[start], token)):
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def _fill(self, start: int) -> None:
        """Entries behind prefix ``start``."""
        piece, last, longest = self.piece, self.last, self.vocabulary.longest
        reachable, fitting, fits = self.vocabulary.reachable, self.vocabulary.fitting, self.vocabulary.fits
        for end in range(start + 1, len(piece) + 1):
            for begin in range(max(0, end - longest), end):
                token = reachable.get(piece[begin:end])
                if token is None:
                    continue
                if begin:
                    good = fitting.get(last[begin] << 32 | token)
                    if not (fits(last[begin], token) if good is None else good):
                        continue
                last.append(token)
                break
            else:
                raise ValueError("the vocabulary lacks a single byte")

    def append(self, more: bytes) -> None:
        """Add bytes at the end; entries so far stay."""
        start = len(self.piece)
        self.piece += more
        self._fill(start)

    def continue_as(self, piece: bytes) -> None:
        """Become the table of another piece, keeping the entries of the common prefix."""
        same, most = 0, min(len(piece), len(self.piece))
        while same < most and piece[same] == self.piece[same]:
            same += 1
        del self.last[same + 1 :]
        self.piece = piece
        self._fill(same)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of bytes ``start`` to ``end``; returns how many entries were made anew.

        Entries before the edit stay. Behind it they are made anew until as many in a row as the
        longest token has bytes come out as before; the others cannot differ then.
        """
        old, tail = self.last, self.last[end + 1 :]
        self.piece = self.piece[:start] + new + self.piece[end:]
        self.last = old[: start + 1]
        shift = len(new) - (end - start)
        same, made = 0, 0
        for at in range(start + 1, len(self.piece) + 1):
            token = self._end(self.piece, at)
            self.last.append(token)
            made += 1
            behind = at - (start + len(new)) - 1
            same = same + 1 if behind >= 0 and old[at - shift] == token else 0
            if same >= self.vocabulary.longest:
                self.last.extend(tail[behind + 1 :])
                break
        return made

    def ids(self) -> list[int]:
        """The encoding: a piece that is a token is that token, else the chain of last tokens."""
        whole = self.vocabulary.ranks.get(self.piece)
        if whole is not None:
            return [whole]
        found, end = [], len(self.piece)
        while end:
            token = self.last[end]
            found.append(token)
            end -= len(self.vocabulary.tokens[token])
        return found[::-1]


class Encoder:
    """Encodes whole columns of text: the prefix tables of all new pieces are filled side by side.

    Pieces that were met before are found by hash, length and first bytes in sorted arrays.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str = PATTERN):
        self.vocabulary = vocabulary
        self.cut = regex.compile(pattern).findall
        self.kinds = _kinds()
        tokens, ranks = vocabulary.tokens, vocabulary.ranks
        most = max(tokens) + 1
        self.token_size = np.zeros(most, np.int64)
        self.born = np.full(most, -1, np.int64)
        self.left, self.right = np.zeros(most, np.int64), np.zeros(most, np.int64)
        for rank, token in tokens.items():
            self.token_size[rank] = len(token)
        for rank, left in vocabulary.left.items():
            self.born[rank], self.left[rank], self.right[rank] = rank, left, vocabulary.right[rank]
        self.token_at = np.concatenate([[0], np.cumsum(self.token_size)])
        self.token_data = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(most)), np.uint8)
        across = {
            ranks[token[:k]] << 32 | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.across = np.array(sorted(across), np.int64)
        self.across_rank = np.array([across[key] for key in self.across.tolist()], np.int64)
        nodes, edges = {b"": 0}, {}
        for token in vocabulary.reachable:
            for k in range(1, len(token) + 1):
                if token[:k] not in nodes:
                    nodes[token[:k]] = len(nodes)
                    edges[nodes[token[: k - 1]] << 8 | token[k - 1]] = nodes[token[:k]]
        self.edge = np.array(sorted(edges), np.int64)
        self.edge_to = np.array([edges[key] for key in self.edge.tolist()], np.int64)
        self.node_token = np.full(len(nodes), -1, np.int64)
        for token, rank in vocabulary.reachable.items():
            self.node_token[nodes[token]] = rank
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.known_data, self.known_from = np.zeros(0, np.uint8), np.zeros(0, np.int64)
        self.known_size = np.zeros(0, np.int64)
        self.known_at, self.known_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known_ids = np.zeros(0, np.uint32)

    def starts(self, chars: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the pieces of the pattern begin, in code points; rows do not run together."""
        n = len(chars)
        kind = self.kinds[chars]
        opens = np.zeros(n + 1, bool)
        opens[bounds] = True
        opens[n] = True
        change = opens.copy()
        change[1:n] |= kind[1:] != kind[:-1]
        space = kind == SPACE
        begin = np.flatnonzero(change[:n])
        end = np.append(begin[1:], n)
        mark = change[:n].copy()
        # white space before other text leaves its last character over, and a blank joins the text
        before_text = space[begin] & ~opens[end]
        lone = end[before_text] - 1
        mark[lone] = True
        joined = lone[chars[lone] == 0x20] + 1
        mark[joined] = False
        # an apostrophe that begins a piece and is followed by one of the short endings
        apostrophe = np.flatnonzero(chars == 0x27)
        apostrophe = apostrophe[mark[apostrophe] & (apostrophe + 1 < n)]
        for ending in ("s", "t", "re", "ve", "m", "ll", "d"):
            at = apostrophe
            for k, letter in enumerate(ending, 1):
                at = at[at + k < n]
                at = at[(chars[at + k] == ord(letter)) & ~opens[at + k]]
            mark[at + 1] = False
            after = at + len(ending) + 1
            mark[after[after < n]] = True
        return np.flatnonzero(mark)

    def fit(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``Vocabulary.fits`` for arrays of neighbours."""
        good = np.zeros(len(x), bool)
        at, limit = np.arange(len(x)), np.full(len(x), 1 << 62)
        while len(at):
            key = x << 32 | y
            found = np.minimum(np.searchsorted(self.across, key), len(self.across) - 1)
            stay = ~((self.across[found] == key) & (self.across_rank[found] < limit))
            bx, by = self.born[x], self.born[y]
            done = stay & (bx < 0) & (by < 0)
            good[at[done]] = True
            stay &= ~done
            at, x, y, bx, by = at[stay], x[stay], y[stay], bx[stay], by[stay]
            first = bx > by
            limit = np.where(first, bx, by + 1)
            x, y = np.where(first, self.right[x], x), np.where(first, y, self.left[y])
        return good

    def tables(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces that lie one behind the other in ``data``: ids in a row, and their numbers."""
        base = np.cumsum(size) - size
        slot = base + np.arange(len(size))
        owner = np.repeat(np.arange(len(size)), size)
        start = np.arange(len(data))
        limit = (base + size)[owner]
        node, depth = np.zeros(len(data), np.int64), 0
        begins, ends, found_token = [], [], []
        while len(start):
            key = node << 8 | data[start + depth]
            found = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            stay = self.edge[found] == key
            start, owner, limit, node = start[stay], owner[stay], limit[stay], self.edge_to[found[stay]]
            depth += 1
            token = self.node_token[node]
            is_token = token >= 0
            begins.append(start[is_token] + owner[is_token])
            ends.append(start[is_token] + owner[is_token] + depth)
            found_token.append(token[is_token])
            more = start + depth < limit
            start, owner, limit, node = start[more], owner[more], limit[more], node[more]
        begin, end, token = map(np.concatenate, (begins, ends, found_token))
        place = end - slot[np.searchsorted(slot, end, "right") - 1]
        # the number of steps is the longest piece's length; the caller bounds it
        order = np.argsort(place, kind="stable")
        begin, end, token, place = begin[order], end[order], token[order], place[order]
        last = np.full(len(data) + len(size), -1, np.int64)
        cuts = np.searchsorted(place, np.arange(1, place[-1] + 2))
        for a, b in zip(cuts[:-1], cuts[1:]):
            before = last[begin[a:b]]
            good = before < 0
            good[~good] = self.fit(before[~good], token[a:b][~good])
            last[end[a:b][good]] = token[a:b][good]
        at, live = slot + size, np.arange(len(size))
        chain, count = [], np.zeros(len(size), np.int64)
        while len(live):
            token = last[at]
            chain.append((live, token))
            count[live] += 1
            at = at - self.token_size[token]
            more = at > slot[live]
            live, at = live[more], at[more]
        ids, stop = np.zeros(count.sum(), np.uint32), np.cumsum(count)
        for step, (live, token) in enumerate(chain, 1):
            ids[stop[live] - step] = token
        return ids, count

    def _new(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces not met before; long ones and those with a token of their own one by one."""
        size = end - start
        short = size <= SIDE_BY_SIDE
        ids, count = np.zeros(0, np.uint32), np.zeros(len(size), np.int64)
        if short.any():
            ids, count[short] = self.tables(data[_gather(start[short], size[short])], size[short])
        alone = ~short
        if len(self.vocabulary.reachable) < len(self.vocabulary.ranks):
            alone |= [data[a:b].tobytes() in self.vocabulary.ranks for a, b in zip(start, end)]
        if alone.any():
            at = np.concatenate([[0], np.cumsum(count)])
            parts = [ids[at[i] : at[i + 1]] for i in range(len(size))]
            for i in np.flatnonzero(alone):
                parts[i] = np.array(PrefixTable(self.vocabulary, data[start[i] : end[i]].tobytes()).ids(), np.uint32)
            ids, count = np.concatenate(parts), np.array([len(part) for part in parts], np.int64)
        return ids, count

    def chunk(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk, and the number of ids up to the end of each row."""
        data, rows = chunk.data, chunk.last - chunk.first
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        byte_at = np.flatnonzero((data & 0xC0) != 0x80)
        row_at = np.unique(chunk.bounds[:-1][chunk.bounds[:-1] < len(data)])
        start = byte_at[self.starts(chars, np.searchsorted(byte_at, row_at))]
        end = np.append(start[1:], len(data))
        hashed, first, inverse = _classes(data, start, end)
        size = (end - start)[first]
        where = np.searchsorted(self.known, hashed)
        near = np.minimum(where, max(len(self.known) - 1, 0))
        old = np.zeros(len(hashed), bool)
        if len(self.known):
            old = (self.known[near] == hashed) & (self.known_size[near] == size)
            maybe = np.flatnonzero(old)
            old[maybe] = same_bytes(data, start[first[maybe]], self.known_data, self.known_from[near[maybe]], size[maybe])
        at, count = np.zeros(len(hashed), np.int64), np.zeros(len(hashed), np.int64)
        at[old], count[old] = self.known_at[near[old]], self.known_n[near[old]]
        new = ~old
        ids, n = self._new(data, start[first[new]], end[first[new]]) if new.any() else (np.zeros(0, np.uint32), count[new])
        at[new], count[new] = len(self.known_ids) + np.cumsum(n) - n, n
        store = np.concatenate([self.known_ids, ids])
        out = store[_gather(at[inverse], count[inverse])]
        row_end = np.concatenate([[0], np.cumsum(count[inverse])])[np.searchsorted(start, chunk.bounds[1:])]
        fresh = new & (size <= SIDE_BY_SIDE)
        fresh[1:] &= hashed[1:] != hashed[:-1]
        if len(self.known):
            fresh &= self.known[near] != hashed
        if len(self.known) + fresh.sum() > REMEMBERED:
            self.forget()
        else:
            self.known_ids = store
            kept = np.where(fresh, size, 0)
            begins = len(self.known_data) + np.cumsum(kept) - kept
            self.known_data = np.concatenate([self.known_data, data[_gather(start[first[fresh]], size[fresh])]])
            parts = {"known_from": begins, "known_size": size, "known_at": at, "known_n": count, "known": hashed}
            for name, part in parts.items():
                setattr(self, name, np.insert(getattr(self, name), where[fresh], part[fresh]))
        return out, row_end

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, and the number of bytes up to the end of each id."""
        size = self.token_size[ids]
        return self.token_data[_gather(self.token_at[ids], size)], np.cumsum(size)

    def piece(self, piece: str) -> bytes:
        return np.array(PrefixTable(self.vocabulary, piece.encode()).ids(), "<u4").tobytes()


def _gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions ``start`` to ``start + size`` of every span, one span behind the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def _classes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and one span of every class of equal spans, ordered by hash, and the class of each span.

    Spans of one hash are compared by their bytes; should they differ, each string is a class.
    """
    value = span_hashes(data, start, end)
    hashed, first, inverse = np.unique(value, return_index=True, return_inverse=True)
    size = end - start
    same = size == size[first[inverse]]
    at = np.flatnonzero(same)
    same[at] = same_bytes(data, start[at], data, start[first[inverse[at]]], size[at])
    if same.all():
        return hashed, first, inverse
    number: dict[tuple[int, bytes], int] = {}
    names = [(h, data[a:b].tobytes()) for h, a, b in zip(value.tolist(), start, end)]
    for name in sorted(set(names)):
        number[name] = len(number)
    inverse = np.array([number[name] for name in names])
    first = np.unique(inverse, return_index=True)[1]
    return value[first], first, inverse


LETTER, NUMBER, SPACE = 1, 2, 3


def _kinds() -> np.ndarray:
    """For every code point whether the pattern sees a letter, a number, white space or another."""
    kinds = np.zeros(0x110000, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for found in regex.finditer(name, every):
                kinds[low + found.start() : low + found.end()] = kind
    return kinds


class EditableText:
    """A text with its ids, which follows appends by encoding its last pieces only.

    More text can change the last pieces (a contraction reaches back over two), never those
    before them; the table of the piece that grows is continued.
    """

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.done, self.rest = b"", []
        self.append(text)

    def append(self, more: str) -> None:
        pieces = self.encoder.cut("".join(self.rest) + more)
        self.done += b"".join(map(self.encoder.piece, pieces[:-3]))
        self.rest = pieces[-3:]

    def ids(self) -> bytes:
        return self.done + b"".join(map(self.encoder.piece, self.rest))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a rank file, made once in each worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(Vocabulary.load(path))
    return _encoders[path]


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian bytes), n_tokens, and digests of ids and of the decoded bytes.

    One row for each row of ``docs``; a null text is empty and has no ids. Other columns are
    ignored. A task holds one Arrow batch and a bounded memory of pieces; a piece of any length
    takes time and memory in proportion to it.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found, ends = own.chunk(chunk)
                data, byte_ends = own.decoded(found)
                stops = np.concatenate([[0], byte_ends])[ends]
                raw = found.astype("<u4").view(np.uint8)
                ids = [raw[4 * a : 4 * b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
                text = [data[a:b].tobytes() for a, b in zip([0, *stops[:-1]], stops)]
                columns = [
                    batch.column(0).slice(chunk.first, chunk.last - chunk.first),
                    pa.array(ids, pa.binary()),
                    pa.array(np.diff(ends, prepend=0)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in text], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
