"""Token ids of whole texts under a public tokenizer file, word by word.

The file's normalizer and pre-tokenizer never look across ASCII white space, so the ids of a text are the ids of
its words in order.  Within a batch each distinct word is cut into *atoms* once: the parts of a plain word, or an odd
word whole.  A pool, bounded in bytes, keeps the ids of atoms between batches of a worker; atoms are looked up and
put together in Arrow, and only new ones become Python strings.  The ids of a part come from a *part encoder*: the
tokenizers library's own model (``library_parts``) or the segment-tree merges of ``keelson.llm.bpe``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from keelson.llm.rows import split_words

#: Bytes of atoms and ids that a worker keeps; results do not depend on it.
REMEMBERED = 32 << 20
#: Words of these characters only take the short way: lower case and split by the file's pattern. In this range
#: composition (NFC) changes nothing and the classes of letters and digits are the same in every Unicode version.
_PLAIN = r"^[\x20-\x7E\x{A1}-\x{12F}\x{131}-\x{17E}]*$"
# The letters and the numbers among them.
_LETTERS = r"A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{17E}"
_NUMBERS = r"0-9\x{B2}\x{B3}\x{B9}\x{BC}-\x{BE}"

PartEncoder = Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = dict.fromkeys(shown)
    hidden = [b for b in range(256) if b not in letters]
    return [chr(b) if b in letters else chr(256 + hidden.index(b)) for b in range(256)]


def library_parts(path: str) -> PartEncoder:
    """Ids of parts by the BPE model of the tokenizers library."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model

    def encode(parts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [[t.id for t in model.tokenize(p)] for p in parts]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    return encode


class _Pool:
    """Id sequences by atom, in Arrow arrays that grow."""

    def __init__(self) -> None:
        self.keys = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.uint32()))

    @property
    def bytes(self) -> int:
        return self.keys.nbytes + self.ids.nbytes

    def find(self, atoms: pa.Array) -> np.ndarray:
        """Where each atom is, or -1."""
        return pc.fill_null(pc.index_in(atoms, value_set=self.keys), -1).to_numpy(zero_copy_only=False)

    def add(self, atoms: pa.Array, ids: pa.Array) -> None:
        self.keys, self.ids = pa.concat_arrays([self.keys, atoms]), pa.concat_arrays([self.ids, ids])


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    """``values`` cut into lists of these sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _plain(words: pa.Array) -> pa.Array:
    return pc.and_(pc.match_substring_regex(words, _PLAIN), pc.invert(pc.match_substring(words, "<|")))


class TextEncoder:
    """Encodes Arrow arrays of texts to ids and counts, equal to the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, parts: PartEncoder, remembered: int = REMEMBERED) -> None:
        import regex
        from tokenizers import Tokenizer

        whole = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.special_at = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        pattern = whole["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = f"({pattern})".replace(r"\p{L}", _LETTERS).replace(r"\p{N}", _NUMBERS)
        letters = byte_letters()
        self.spelled = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x800)}
        self.encode_parts, self.remembered = parts, remembered
        self.pool = _Pool()

    def _odd_parts(self, word: str) -> list[str | int]:
        """Parts of any word in byte letters, by the library's own steps; an integer is a special token's id."""
        parts: list[str | int] = []
        at = 0
        for m in [*self.special_at.finditer(word), None]:
            piece = word[at : m.start() if m else len(word)]
            parts += [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))] if piece else []
            if m:
                parts.append(self.special[m.group()])
                at = m.end()
        return parts

    def _atoms(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The atoms of all words in order, and how many each word has."""
        plain, low = _plain(words), pc.utf8_lower(words)
        cut = pc.replace_substring_regex(low, pattern=f"([^{_LETTERS}]+)", replacement=r" \1 ")  # runs of letters and of signs
        full = pc.and_(plain, pc.match_substring_regex(words, f"['{_NUMBERS}]"))  # what else the pattern tells apart
        if pc.any(full).as_py():
            cut = pc.replace_with_mask(cut, full, pc.replace_substring_regex(low.filter(full), pattern=self.pattern, replacement=r"\1 "))
        return split_words(pc.if_else(plain, cut, words))

    def _learned(self, atoms: pa.Array) -> pa.Array:
        """Ids of atoms that the pool lacks."""
        plain = _plain(atoms).to_numpy(zero_copy_only=False)
        texts = atoms.to_pylist()
        if plain.all():
            return _lists(*reversed(self.encode_parts([t if t.isascii() else t.translate(self.spelled) for t in texts])))
        pieces = [[t if t.isascii() else t.translate(self.spelled)] if p else self._odd_parts(t) for t, p in zip(texts, plain)]
        wanted = list(dict.fromkeys(x for some in pieces for x in some if isinstance(x, str)))
        ids, sizes = self.encode_parts(wanted)
        ends = np.cumsum(sizes).tolist()
        known = {w: ids[e - n : e].tolist() for w, e, n in zip(wanted, ends, sizes.tolist())}
        return pa.array([[i for x in some for i in (known[x] if isinstance(x, str) else [x])] for some in pieces], pa.list_(pa.uint32()))

    def _slots(self, atoms: pa.Array) -> np.ndarray:
        """Where the pool has each of these distinct atoms, after learning those it lacks."""
        slots = self.pool.find(atoms)
        if (slots < 0).any():
            if self.pool.bytes > self.remembered:
                self.pool, slots = _Pool(), np.full(len(atoms), -1, slots.dtype)
            new = np.flatnonzero(slots < 0)
            first = len(self.pool.keys)
            lacking = atoms.take(pa.array(new))
            self.pool.add(lacking, self._learned(lacking))
            slots = slots.copy()
            slots[new] = np.arange(first, first + len(new))
        return slots

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has; a null text has none."""
        words, n_words = split_words(texts)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(n_words), np.int64)
        words = words.dictionary_encode()
        atoms, n_atoms = self._atoms(words.dictionary)
        atoms = atoms.dictionary_encode()
        slots = self._slots(atoms.dictionary).astype(np.int32)[atoms.indices.to_numpy()]
        word_ids = self.pool.ids.take(pa.array(slots))  # the ids of each distinct word, atom by atom
        upto = np.concatenate([[0], np.cumsum(pc.list_value_length(word_ids).to_numpy())])
        ends = np.cumsum(n_atoms)
        sizes = upto[ends] - upto[ends - n_atoms]
        flat = _lists(sizes, pc.list_flatten(word_ids).to_numpy()).take(words.indices)
        total = np.concatenate([[0], np.cumsum(sizes[words.indices.to_numpy()])])
        ends = np.cumsum(n_words)
        return pc.list_flatten(flat).to_numpy(), total[ends] - total[ends - n_words]


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, kind: str = "library") -> TextEncoder:
    """This worker's encoder for a file; ``kind`` is ``library`` or ``tree``."""
    if (path, kind) not in _ENCODERS:
        if kind == "tree":
            from keelson.llm.bpe import tree_parts

            _ENCODERS[path, kind] = TextEncoder(path, tree_parts(path))
        else:
            _ENCODERS[path, kind] = TextEncoder(path, library_parts(path))
    return _ENCODERS[path, kind]
