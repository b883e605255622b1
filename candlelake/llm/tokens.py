"""Token ids of whole texts in Arrow batches, as the ``tokenizers`` library gives them.

A text is cut before each space that no white space precedes. The byte-level pre-tokeniser always
starts a new word there, so the units between the cuts encode independently and very long texts need
no special path. Of a slice, only the distinct units are encoded, nearly all of them in one call. A run of white space can form one
token, so it is never cut: it stays at the start of the unit that follows.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space after white space (RE2): no safe boundary.
RUN = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "
#: Fixed value: the word pattern of the byte-level scheme.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where a text with runs of white space may be cut: between a character that is none and a space. CUT marks the place.
CUT = "\U0010ffff"
SAFE = r"([^\s\x0b\x1c-\x1f\x{85}\p{Z}]) "
#: Units that are encoded alone: empty, or with white space at their end.
EDGE = r"^$|[\s\x0b\x1c-\x1f\x{85}\p{Z}]$"


def same_scheme(spec: dict):
    """The same byte-level BPE in the tiktoken library, which is faster, or None.

    Both give the same ids if every merge makes the next id after the 256 bytes, so that the order of
    merges is the order of ids, and no option of the file changes the plain scheme.
    """
    model = spec["model"]
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in options):
        return None
    try:
        import tiktoken
    except ImportError:
        return None
    added = {t["content"] for t in spec.get("added_tokens") or []}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    vocab = {w: k for w, k in model["vocab"].items() if w not in added}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if sorted(vocab[c] for c in signs if c in vocab) != list(range(256)) or [vocab.get(m) for m in merges] != list(range(256, 256 + len(merges))):
        return None
    ranks = {bytes(signs[c] for c in w): k for w, k in vocab.items()}
    if len(ranks) != 256 + len(merges):
        return None
    return tiktoken.Encoding("same", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class UnitEncoder:
    """Encodes Arrow string arrays with one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        #: Cuts are known to be safe for the plain byte-level scheme only.
        self.safe = pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        size = self.tokenizer.get_vocab_size()
        self.spaced = np.array([(self.tokenizer.id_to_token(k) or "").startswith("Ġ") for k in range(size)])
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.fast = same_scheme(spec) if self.safe else None

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def run(self, text: str) -> np.ndarray:
        """Ids of a text without added tokens and without a character that UTF-8 lacks."""
        if self.fast is not None:
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def inner(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of distinct units, each with a space before it: most of them in one call."""
        odd = pc.match_substring_regex(names, EDGE)
        for added in self.added:
            odd = pc.or_(odd, pc.match_substring(names, added))
        odd = odd.to_numpy(zero_copy_only=False)
        plain, alone = np.flatnonzero(~odd), np.flatnonzero(odd)
        ids = self.run(" " + " ".join(names.take(pa.array(plain)).to_pylist())) if len(plain) else np.empty(0, "<u4")
        at = np.flatnonzero(self.spaced[ids])
        if len(at) != len(plain):  # another scheme of spaces than expected
            plain, alone, ids, at = plain[:0], np.arange(len(names)), ids[:0], at[:0]
        rest = self.whole([" " + names[k].as_py() for k in alone.tolist()])
        length = np.empty(len(names), np.int64)
        length[plain] = np.diff(np.append(at, len(ids)))
        length[alone] = [len(x) // 4 for x in rest]
        return joined([(plain, length[plain], ids), (alone, length[alone], np.frombuffer(b"".join(rest), "<u4"))], length), length

    def in_units(self, texts: pa.Array, cut: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, ids one after the other) of texts with runs of white space, by distinct units if they may be cut."""
        if not cut:
            got = self.whole(texts.to_pylist())
            return np.array([len(x) // 4 for x in got], np.int64), np.frombuffer(b"".join(got), "<u4")
        split = pc.split_pattern(pc.replace_substring_regex(texts, SAFE, rf"\1{CUT} "), CUT)
        edges = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        code, names = coded.indices.to_numpy(), coded.dictionary
        got = self.whole(names.to_pylist())
        size = np.array([len(x) // 4 for x in got], np.int64)
        ids, begin = np.frombuffer(b"".join(got), "<u4"), np.cumsum(size) - size
        each = size[code]
        ends = np.concatenate([[0], np.cumsum(each)])
        return np.diff(ends[edges]), ids[np.repeat(begin[code] - ends[:-1], each) + np.arange(ends[-1])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text starts: one more than texts). NULL is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        odd = pc.match_substring_regex(texts, RUN).to_numpy(zero_copy_only=False) if self.safe else np.ones(n, bool)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # texts, lengths, ids
        if not odd.all():
            at = np.flatnonzero(~odd)
            split = pc.split_pattern(texts.take(pa.array(at)), " ")
            edges = split.offsets.to_numpy() - split.offsets[0].as_py()
            coded = split.flatten().dictionary_encode()
            code, names = coded.indices.to_numpy(), coded.dictionary
            ids, length = self.inner(names)
            # the first unit of a text has no space before it
            heads, which = np.unique(code[edges[:-1]], return_inverse=True)
            first = self.whole(names.take(pa.array(heads)).to_pylist())
            code = code.copy()
            code[edges[:-1]] = len(names) + which
            length = np.concatenate([length, [len(x) // 4 for x in first]]).astype(np.int32)
            ids = np.concatenate([ids, np.frombuffer(b"".join(first), "<u4")])
            begin = (np.cumsum(length, dtype=np.int64) - length).astype(np.int32)
            size = length[code]
            ends = np.cumsum(size, dtype=np.int64)
            step = np.repeat((begin[code] - (ends - size)).astype(np.int32), size)
            step += np.arange(len(step), dtype=np.int32)
            parts.append((at, np.diff(np.concatenate([[0], ends])[edges]), ids[step]))
        if odd.any():
            at = np.flatnonzero(odd)
            rest = texts.take(pa.array(at))
            alone = pc.match_substring(rest, CUT).to_numpy(zero_copy_only=False) if self.safe else np.ones(len(at), bool)
            for some, cut in ((np.flatnonzero(~alone), True), (np.flatnonzero(alone), False)):
                if len(some):
                    parts.append((at[some], *self.in_units(rest.take(pa.array(some)), cut)))
        lengths = np.zeros(n, np.int64)
        for at, size, _ in parts:
            lengths[at] = size
        return joined(parts, lengths), np.concatenate([[0], np.cumsum(lengths)])


def joined(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], lengths: np.ndarray) -> np.ndarray:
    """The ids of parts (places, lengths, ids) in the order of their places."""
    parts = [p for p in parts if len(p[0])]
    if len(parts) == 1:
        return parts[0][2]
    offsets = np.cumsum(lengths) - lengths
    out = np.empty(int(lengths.sum()), "<u4")
    for at, size, ids in parts:
        out[np.repeat(offsets[at] - (np.cumsum(size) - size), size) + np.arange(len(ids))] = ids
    return out


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder per tokenizer file and Python worker."""
    if path not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


class PieceEncoder:
    """Counts only, for SentencePiece models: whole texts, in batches."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]


_PIECES: dict[str, PieceEncoder] = {}


def counts(path: str, texts: pa.Array) -> np.ndarray:
    """Tokens of each text; the file's ending names the library."""
    if path.endswith(".model"):
        if path not in _PIECES:
            _PIECES[path] = PieceEncoder(path)
        return np.array(_PIECES[path].counts(pc.fill_null(texts, "").to_pylist()), np.int64)
    return np.diff(encoder(path).encode(texts)[1])
