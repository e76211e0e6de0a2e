"""Edit-aware token counts: a segment tree of pre-tokens per document.

The leaves of a document's tree are runs of about ``LEAF`` pre-tokens with their texts and token
counts; inner nodes hold the sums of characters and tokens below. Byte-level BPE encodes each
pre-token alone, so after an edit only the pre-tokens around it can change: the text is cut anew from
a boundary ``Encoder.context`` characters before the edit up to the first boundary behind it that the
old and the new cut share. The pattern never looks back, so from there on both cuts are the same. The
leaves touched get the new pre-tokens, and the sums on the way to the root are updated. An added token's
string is a piece of its own, with one token.

``count_edited`` applies a list of edits to every document and returns the counts before and after,
and how many pre-tokens had to be encoded again. ``TokenTree.dump`` and ``load`` keep a tree as bytes
next to its text, so later edits need no first encoding.

Edge cases. Null texts are empty and have no tokens. Edits are (start, end, replacement) in code
points of the original text; they are taken in order of start, clipped to the text, and one that
begins before an earlier one ends is left out; null edits and null positions are left out, a null
replacement deletes. Texts of any characters have their tree. Only those with the string of an added
token that takes its neighbours into account (``Encoder.loose``), before or after their edits, are encoded
whole; all their pre-tokens count as encoded again if they have edits. Repeated rows are counted each by
itself, extra columns are ignored by ``count_edited``, an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.tokenizing import CONTEXT, Encoder, encoder

LEAF = 64

Edit = tuple[int, int, str]


class TokenTree:
    """Token counts of one text that follow its edits."""

    def __init__(self, enc: Encoder, pieces: list[str], counts: list[int]) -> None:
        self.enc = enc
        self.encoded = 0                                       # pre-tokens encoded since the tree was made
        self._build([(pieces[k:k + LEAF], counts[k:k + LEAF]) for k in range(0, len(pieces), LEAF)])

    @classmethod
    def of(cls, enc: Encoder, text: str) -> TokenTree:
        pieces = enc.cut(text)
        return cls(enc, pieces, list(map(enc.count, pieces)))

    def _build(self, leaves: list[tuple[list[str], list[int]]]) -> None:
        self.leaves = leaves or [([], [])]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for i, (pieces, counts) in enumerate(self.leaves):
            self.chars[self.base + i], self.tokens[self.base + i] = sum(map(len, pieces)), sum(counts)
        for at in range(self.base - 1, 0, -1):
            self._sum(at)

    def _sum(self, at: int) -> None:
        self.chars[at] = self.chars[2 * at] + self.chars[2 * at + 1]
        self.tokens[at] = self.tokens[2 * at] + self.tokens[2 * at + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(p for pieces, _ in self.leaves for p in pieces)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last one for the end), and its start."""
        at, start = 1, 0
        while at < self.base:
            at *= 2
            if place >= start + self.chars[at] and self.chars[at + 1]:
                start += self.chars[at]
                at += 1
        return min(at - self.base, len(self.leaves) - 1), start

    def _set_leaf(self, i: int, pieces: list[str], counts: list[int]) -> None:
        self.leaves[i] = (pieces, counts)
        at = self.base + i
        self.chars[at], self.tokens[at] = sum(map(len, pieces)), sum(counts)
        while at > 1:
            at >>= 1
            self._sum(at)

    def replace(self, start: int, end: int, new: str) -> None:
        """Replace the characters start..end-1 by ``new``."""
        context = self.enc.context
        first, origin = self._leaf_at(max(0, start - context))
        pieces, counts = self.leaves[first]
        # Pre-tokens that end ``context`` characters before the edit cannot see it.
        keep, at = 0, origin
        while keep < len(pieces) and at + len(pieces[keep]) <= start - context:
            at += len(pieces[keep])
            keep += 1
        last, stop = first, origin + self.chars[self.base + first]
        while stop < end:
            last += 1
            stop += self.chars[self.base + last]
        reach = 1
        while True:                                            # more text behind, until the cuts agree
            while last + 1 < len(self.leaves) and reach:
                last += 1
                stop += self.chars[self.base + last]
                reach -= self.chars[self.base + last] > 0
            whole = last + 1 == len(self.leaves)
            old = [*pieces[keep:], *(p for leaf in self.leaves[first + 1:last + 1] for p in leaf[0])]
            text = "".join(old)
            cut = self._cut(old, text[:start - at] + new, text[end - at:], end - at, whole)
            if cut is not None:
                break
            reach = 2 * (last - first + 1)
        fresh, rest = cut
        old_counts = [*counts[keep:], *(c for leaf in self.leaves[first + 1:last + 1] for c in leaf[1])]
        same = 0                                               # out of the pattern's sight, no added token made or broken
        while same < min(len(fresh), len(old)) and fresh[same] == old[same] and at + len(old[same]) <= start - CONTEXT:
            at += len(old[same])
            same += 1
        self.encoded += len(fresh) - same
        new_pieces = pieces[:keep] + fresh + old[len(old) - rest:]
        new_counts = counts[:keep] + old_counts[:same] + list(map(self.enc.count, fresh[same:])) + old_counts[len(old) - rest:]
        room = last - first + 1
        size = -(-len(new_pieces) // room)
        if size > 4 * LEAF:                                    # grown: cut all leaves anew
            leaves = [*self.leaves[:first], (new_pieces, new_counts), *self.leaves[last + 1:]]
            all_pieces, all_counts = [p for x, _ in leaves for p in x], [c for _, x in leaves for c in x]
            self._build([(all_pieces[k:k + LEAF], all_counts[k:k + LEAF]) for k in range(0, len(all_pieces), LEAF)])
            return
        for j in range(room):
            self._set_leaf(first + j, new_pieces[j * size:(j + 1) * size], new_counts[j * size:(j + 1) * size])

    def _cut(self, old: list[str], before: str, after: str, edit_end: int, whole: bool) -> tuple[list[str], int] | None:
        """New pre-tokens up to where old and new cut agree, and the number of old ones that stay.

        ``before`` and ``after`` make up the new text; ``after`` is also the old text from
        ``edit_end`` on. Without an agreement that the end of a partial text cannot touch: None.
        """
        ends, at = {}, 0
        for k, piece in enumerate(old):
            if at >= edit_end:
                ends[at - edit_end] = len(old) - k             # boundary in ``after``: pieces from there on
            at += len(piece)
        text, fresh = before + after, []
        safe = len(text) if whole else len(text) - self.enc.context
        place = 0
        for piece in self.enc.cut(text):
            if place >= len(before) and place - len(before) in ends and place <= safe:
                return fresh, ends[place - len(before)]
            place += len(piece)
            if place > safe:
                return None
            fresh.append(piece)
        return (fresh, 0) if whole else None

    def dump(self) -> bytes:
        """Lengths and counts of the pre-tokens, as bytes; the text is kept elsewhere."""
        lengths = np.array([len(p) for pieces, _ in self.leaves for p in pieces], "<u4")
        counts = np.array([c for _, counts in self.leaves for c in counts], "<u4")
        return struct.pack("<I", len(lengths)) + lengths.tobytes() + counts.tobytes()

    @classmethod
    def load(cls, enc: Encoder, text: str, data: bytes) -> TokenTree:
        n = struct.unpack_from("<I", data)[0]
        lengths, counts = (np.frombuffer(data, "<u4", n, 4 + 4 * n * k).tolist() for k in (0, 1))
        ends = np.cumsum([0, *lengths]).tolist()
        return cls(enc, [text[a:b] for a, b in zip(ends, ends[1:])], counts)


def clean_edits(edits: list[Edit], n: int) -> list[Edit]:
    """Edits in order, within a text of ``n`` characters, without overlaps."""
    out, reached = [], 0
    for start, end, new in sorted(edits, key=lambda e: (e[0], e[1], e[2])):
        start, end = min(max(start, 0), n), min(max(end, start, 0), n)
        if start >= reached:
            out.append((start, end, new))
            reached = max(end, reached)
    return out


def edited_counts(enc: Encoder, text: str, edits: list[Edit]) -> tuple[int, int, int, int, int]:
    """Tokens before, edits applied, tokens after, pre-tokens encoded again, pre-tokens before."""
    edits = clean_edits(edits, len(text))
    if enc.loose and (enc.is_loose(text) or enc.is_loose(apply_edits(text, edits))):
        return _whole_counts(enc, text, edits)
    tree = TokenTree.of(enc, text)
    before, pieces = tree.n_tokens, sum(len(p) for p, _ in tree.leaves)
    for start, end, new in reversed(edits):                    # from the back: earlier places stay valid
        tree.replace(start, end, new)
    return before, len(edits), tree.n_tokens, tree.encoded, pieces


def apply_edits(text: str, edits: list[Edit]) -> str:
    for start, end, new in reversed(edits):
        text = text[:start] + new + text[end:]
    return text


def _whole_counts(enc: Encoder, text: str, edits: list[Edit]) -> tuple[int, int, int, int, int]:
    before, pieces = enc.whole(text)
    after, again = enc.whole(apply_edits(text, edits)) if edits else (before, 0)
    return before, len(edits), after, again, pieces


#: Addresses, long numbers and keys, as (pattern, replacement).
SCRUB = tuple((re.compile(p), r) for p, r in (
    (r"[\w.+-]+@[\w-]+\.[\w.-]*\w", "<email>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<ip>"),
    (r"\b[0-9a-fA-F]{32,}\b", "<key>"),
    (r"\+?\d[\d ()-]{8,}\d", "<number>")))


def scrub_edits(text: str) -> list[Edit]:
    """Edits that mask personal data and keys, and delete lines that repeat an earlier one."""
    edits = [(m.start(), m.end(), new) for pattern, new in SCRUB for m in pattern.finditer(text)]
    seen, at = set(), 0
    for line in text.split("\n"):
        if at and line in seen and line:
            edits.append((at - 1, at + len(line), ""))
        seen.add(line)
        at += len(line) + 1
    return edits


COUNTS = "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_encoded_again long, n_pre_tokens long"


def count_edited(docs: DataFrame, tokenizer_path: str, rule: Callable[[str], list[Edit]] | None = scrub_edits) -> DataFrame:
    """Token counts of ``docs`` (doc_id, text) before and after their edits.

    Edits come from ``rule``, or, if it is None, from a column ``edits``
    array<struct<start:int,end:int,new:string>>.
    """
    columns = [F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")]
    names = [f.split()[0] for f in COUNTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                edits = rule(text) if rule else [
                    (e["start"], e["end"], e["new"] or "") for e in batch.column(2)[k].as_py() or ()
                    if e is not None and e["start"] is not None and e["end"] is not None]
                rows.append(edited_counts(enc, text, edits))
            values = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(v, pa.int64()) for v in values)], names)

    return docs.select(*columns, *([] if rule else ["edits"])).mapInArrow(run, COUNTS)
