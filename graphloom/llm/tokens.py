"""Whole texts to token ids by the tokenizers library, with a bounded cache of pieces.

Both vocabularies used here split a text into pieces before they merge, and no merge crosses a piece. Cutting a
text before single blanks and line feeds, and between a letter and a punctuation mark, cuts only between pieces,
so the ids of a text are those of its cuts in a row, and each distinct cut of a batch is encoded once. Letters that
the vocabulary's normalizer turns into something else than one letter end no cut. Where a blank belongs to the next
piece, texts with other white space are encoded whole; so are texts that hold a special token's string, which the
library turns into that token.

New cuts that are one run of Latin letters are one piece each, which goes to the vocabulary's model without the
search for pieces; where the model merges nothing with some byte, many of them go at once with that byte between. Others
are encoded many at a time, with a separator between them that is a piece of its own.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Cuts that a task keeps, those of the last slices first: about 20 MB, as they lie in arrays.
CACHE_CUTS = 300_000
#: Bytes of a longest cut that is kept.
LONGEST_KEPT = 64
SLICE_BYTES = 2 << 20
#: Cuts encoded as one string.
JOINED = 200
#: Words that go to the model as one string.
JOINED_WORDS = 100
#: Runs of letters that stay single letters when normalized (İ doesn't), with the blank that belongs to the piece.
LETTERS = "^ ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"
MARK = r"([!-/:-@\[-`{-~])"
#: White space other than blank and line feed, and the mark below.
ODD_SPACE = r"[\x00\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _hidden_bytes() -> list[tuple[str, str]]:
    """Bytes that can't be seen, and the character that stands for each in a byte-level vocabulary: the next from 256
    on. The line feed is left alone: it parts the words. The bytes before the blank are in no word."""
    hidden = [k for k in range(256) if not (33 <= k <= 126 or (k >= 161 and k != 173))]
    return [(chr(k), chr(256 + n)) for n, k in enumerate(hidden) if k >= 32]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _places(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, one range after the other. Places fit 4 bytes: a slice is a few MB or one
    text, and a text's ids are no more than its bytes."""
    to = np.cumsum(size)
    out = np.repeat((begin - to + size).astype(np.int32), size)
    out += np.arange(len(out), dtype=np.int32)
    return out


def _is_letter(x: str) -> bool:
    return len(x) == 1 and unicodedata.category(x)[0] == "L"


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        a, b, one = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("a", " a", "\x01"))
        self.blank_in_piece = a != b
        self.separator = "\n" if self.blank_in_piece else " \x01 "
        self.separator_id = self.tokenizer.encode("\n", add_special_tokens=False).ids[0] if self.blank_in_piece else one[0]
        self.specials = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.hidden, self.lower = self.tokenizer.model, _hidden_bytes(), self.tokenizer.normalizer is not None
        tried = ["a", "Zum", "été", "Ærø", "naïve", "straßenbahn", "ŁÓDŹ", *(" Zum", " été") * self.blank_in_piece]
        self.joint = self._mark_without_merges()
        ids, size = self._encode_words(tried)
        self.by_model = [x.tobytes() for x in np.split(ids, np.cumsum(size)[:-1])] == self._encode(tried)
        self.letter_and_mark = f"([^\\P{{L}}{self._unlike_letters()}]){MARK}"
        self.forget()

    def _unlike_letters(self) -> str:
        """The letters that the normalizer doesn't turn into one letter, for a class of a pattern."""
        if self.tokenizer.normalizer is None:
            return ""
        letters = [chr(k) for k in range(0x110000) if _is_letter(chr(k))]
        turned = self.tokenizer.normalizer.normalize_str(" ".join(letters)).split(" ")
        return "".join(f"\\x{{{ord(x):x}}}" for x, y in zip(letters, turned, strict=True) if not _is_letter(y))

    def _encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for k in range(0, len(texts), 500):
            out += [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts[k : k + 500], add_special_tokens=False)]
        return out

    def _mark_without_merges(self) -> str | None:
        """What stands for the byte 1, which no letter has, if it is in no other entry of the vocabulary: then a string
        with it between words has the words' ids with its own between them."""
        mark, model = chr(256 + 1), self.model
        plain = not (getattr(model, "end_of_word_suffix", "-") or getattr(model, "continuing_subword_prefix", "-") or model.dropout)
        return mark if plain and [x for x in self.tokenizer.get_vocab(with_added_tokens=False) if mark in x] == [mark] else None

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts that LETTERS matches, in a row, and how many each has."""
        text = "\n".join(words)
        shown = (text.lower() if self.lower else text).encode().decode("latin-1")
        for byte, instead in self.hidden:
            shown = shown.replace(byte, instead)
        tokenize, pieces = self.model.tokenize, shown.split("\n")
        if self.joint:
            mark, ids = self.joint, array("I")
            for k in range(0, len(pieces), JOINED_WORDS):
                ids.extend([y.id for y in tokenize(mark.join(pieces[k : k + JOINED_WORDS]) + mark)])
            ids = np.array(ids, "<u4")
            at = np.flatnonzero(ids == self.model.token_to_id(mark))
            return np.delete(ids, at), np.diff(at, prepend=-1) - 1
        own = [array("I", [y.id for y in tokenize(x)]).tobytes() for x in pieces]
        return np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), np.int64, len(own)) // 4

    def _encode_new(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where each cut's begin, and how many it has."""
        is_word = np.asarray(pc.match_substring_regex(cuts, LETTERS)) if self.by_model else np.zeros(len(cuts), bool)
        words, size = np.zeros(0, "<u4"), np.zeros(len(cuts), np.int64)
        if is_word.any():
            words, size[is_word] = self._encode_words(_strings(cuts.filter(pa.array(is_word))))
        others = self._encode_cuts(_strings(cuts.filter(pa.array(~is_word))))
        size[~is_word] = np.fromiter(map(len, others), np.int64, len(others)) // 4
        begin = np.empty(len(cuts), np.int64)
        begin[is_word] = np.cumsum(size[is_word]) - size[is_word]
        begin[~is_word] = len(words) + np.cumsum(size[~is_word]) - size[~is_word]
        return np.concatenate([words, np.frombuffer(b"".join(others), "<u4")]), begin, size

    def _encode_cuts(self, cuts: list[str]) -> list[bytes]:
        """Ids of each cut. What could touch a separator, or is one, is encoded alone."""
        mark = self.separator.strip(" ")
        alone = [k for k, x in enumerate(cuts) if not x.strip() or mark in x]
        out: list[bytes] = [b""] * len(cuts)
        for k, x in zip(alone, self._encode([cuts[k] for k in alone]), strict=True):
            out[k] = x
        skip = set(alone)
        rest = [k for k in range(len(cuts)) if k not in skip] if skip else range(len(cuts))
        for lo in range(0, len(rest), 20 * JOINED):
            groups = [rest[a : a + JOINED] for a in range(lo, min(len(rest), lo + 20 * JOINED), JOINED)]
            coded = self.tokenizer.encode_batch_fast([self.separator.join([cuts[k] for k in g]) for g in groups], add_special_tokens=False)
            for g, x in zip(groups, coded, strict=True):
                ids = np.array(x.ids, "<u4")
                at = np.flatnonzero(ids == self.separator_id)
                if len(at) != len(g) - 1:
                    own = self._encode([cuts[k] for k in g])
                else:
                    raw, ends = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
                    own = [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends[:-1])], ends, strict=True)]
                for k, y in zip(g, own, strict=True):
                    out[k] = y
        return out

    def forget(self) -> None:
        self.cuts, self.ids, self.begin, self.size = pa.array([], pa.large_string()), np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _known(self, cuts: pa.Array, distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and of each cut where they begin and how many. The first cuts, so many, are distinct and may be kept."""
        n_kept = len(self.cuts)
        which = pc.fill_null(pc.index_in(cuts, value_set=self.cuts), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(which < 0)
        which[new] = n_kept + np.arange(len(new))
        ids, begin, size = self._encode_new(cuts.take(pa.array(new)))
        ids, begin, size = np.concatenate([self.ids, ids]), np.concatenate([self.begin, begin + len(self.ids)]), np.concatenate([self.size, size])
        # what this slice uses goes first, then what was kept before, the most lately used first
        unused = np.ones(n_kept + len(new), bool)
        unused[which] = False
        brief = np.flatnonzero(np.asarray(pc.binary_length(cuts[:distinct])) <= LONGEST_KEPT)[:CACHE_CUTS]
        rest = np.flatnonzero(unused[:n_kept])[: CACHE_CUTS - len(brief)]
        self.cuts = pa.concat_arrays([cuts.take(pa.array(brief)), self.cuts.take(pa.array(rest))])
        held = np.concatenate([which[brief], rest])
        self.size = size[held]
        self.ids, self.begin = ids[_places(begin[held], self.size)], np.cumsum(self.size) - self.size
        return ids, begin[which], size[which]

    def slices(self, column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids of consecutive rows in a row, where each row's begin and the last ends), of texts of `most`
        bytes or of one longer text. Nulls are empty."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if column.offset or len(column) and np.frombuffer(column.buffers()[1], np.int64, 1)[0]:
            column = pa.concat_arrays([column, column[:0]])  # ascii_lower misreads places that don't start at 0
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        lo = 0
        while lo < len(column):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + most, "right")))
            yield lo, *self._slice(column[lo:hi])
            lo = hi

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.blank_in_piece:
            spaced = pc.replace_substring(pc.replace_substring_regex(texts, self.letter_and_mark, "\\1 \x00\\2"), "\n", " \n")
        else:
            spaced = pc.replace_substring(pc.replace_substring_regex(pc.ascii_lower(texts), self.letter_and_mark, "\\1 \\2"), "\n", " ")
        bad = np.zeros(len(texts), bool)
        for x in self.specials:
            bad |= np.asarray(pc.match_substring(texts, x))
        lists = pc.split_pattern(spaced, " ")
        at = np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        codes, vocabulary = np.asarray(coded.indices, np.int64), coded.dictionary
        distinct = len(vocabulary)
        if self.blank_in_piece:
            odd = np.asarray(pc.is_in(vocabulary, value_set=pa.array(["", "\n"], vocabulary.type)))
            bad |= np.add.reduceat(odd[codes], at[:-1]) > 0
            bad |= np.asarray(pc.match_substring_regex(texts, ODD_SPACE))
            firsts = vocabulary.take(pa.array(codes[at[:-1]]))
            codes[at[:-1]] = distinct + np.arange(len(firsts))
            none, blank = pa.scalar("", vocabulary.type), pa.scalar(" ", vocabulary.type)
            before = pc.if_else(pc.or_(pa.array(odd), pc.match_substring_regex(vocabulary, "^[\\x00\n]")), none, blank)
            vocabulary = pa.concat_arrays([pc.replace_substring_regex(pc.binary_join_element_wise(before, vocabulary, none), "^\\x00", ""), firsts])
        flat, begin, size = self._known(vocabulary, distinct)
        each = size[codes]
        to = np.cumsum(each)
        ids = flat[_places(begin[codes], each)]
        bounds = np.concatenate([[0], to])[at]
        rows = np.flatnonzero(bad)
        if len(rows):
            whole = dict(zip(rows.tolist(), self._encode(texts.take(pa.array(rows)).to_numpy(zero_copy_only=False).tolist()), strict=True))
            parts = [np.frombuffer(whole[k], "<u4") if k in whole else ids[bounds[k] : bounds[k + 1]] for k in range(len(texts))]
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return ids, bounds


def larger(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about this many bytes or more: cuts that repeat in a batch are looked up once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.nbytes for x in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


_encoders: dict[str, Encoder] = {}


@contextmanager
def encoder(path: str) -> Iterator[Encoder]:
    """One for each worker process and vocabulary; the cuts that it keeps go when the task ends, for a worker outlives
    many tasks and other operators need its memory."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    try:
        yield _encoders[path]
    finally:
        _encoders[path].forget()
