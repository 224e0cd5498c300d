"""Token ids of whole texts by the tokenizers library, made quickly inside tasks.

Both tokenizers cut a text before their merges: neither merges across the blank between two
words. A text can therefore be cut there into pieces, every distinct piece encoded once by the
library, and the ids of a text put together from its pieces; signs behind a word are a piece of
their own, and plain words go straight to the library's merges. Texts with runs of white space that
such a cut would change go to the library whole. Ids are held as little-endian uint32 bytes.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tripfold.llm.common import held_by_worker

# Pieces a worker's store takes before it becomes the older half of the next: 30 MB or so each.
STORED_PIECES = 250_000
# Letters that no normalisation joins or cuts: a run of them is one word to both tokenizers.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
# So many characters of new pieces go to the library in one call.
BATCH_CHARS = 4000
# Signs that both tokenizers cut off a letter or digit before them.
SIGNS = ",.;:!?&%$*#"
# A character no piece has stands between pieces in a call.
MARK = "\x01"


def encoder(name: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, a path or a name the public set knows."""
    return held_by_worker(f"tokenizer {name}", lambda: PieceEncoder(name))


class PieceEncoder:
    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        if not os.path.isabs(name):
            import public_tokenizers

            name = public_tokenizers.path(name)
        self.library = Tokenizer.from_file(name)
        # Does the tokenizer drop white space, or put it before the next word?
        self.drops_space = not self._whole(" ")
        self.mark = self._mark_id()
        self.model = self.library.model
        self.letters = str.maketrans({letter: self._symbols(letter) for letter in LETTERS})
        self.blank = "" if self.drops_space else self._symbols(" ")
        self.feed = b"" if self.drops_space else self._whole("\n")
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.id_bytes = [number.tobytes() for number in np.arange(size, dtype="<u4")]
        self.stored = _Store({})

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _symbols(self, character: str) -> str:
        """What the tokenizer hands to its merges for a character."""
        if self.library.normalizer:
            character = self.library.normalizer.normalize_str(character)
        return self.library.pre_tokenizer.pre_tokenize_str(character)[0][0]

    def _word(self, lead: str, letters: str) -> bytes:
        """The ids of letters, which no tokenizer cuts, straight from the library's merges."""
        merged = self.model.tokenize(lead + letters.translate(self.letters))
        return b"".join([self.id_bytes[token.id] for token in merged])

    def _mark_id(self) -> int:
        ids = self.library.encode(MARK, add_special_tokens=False).ids
        if len(ids) != 1:
            raise ValueError("the tokenizer has no id of its own for the mark")
        return ids[0]

    def encode(self, text: str) -> bytes:
        """The ids of a text."""
        tail = b""
        if self.drops_space:
            pieces = text.replace("\n", " ").split(" ")
        else:
            body = text.rstrip()
            if not body or _UNSAFE(body):
                return self._whole(text)
            pieces = body.replace("\n", " \n").split(" ")
            if pieces[0]:
                pieces[0] = (pieces[0],)
            if len(body) < len(text):
                tail = self._whole(text[len(body) :])
        stored = self._store()
        found = list(map(stored.__getitem__, pieces))
        if stored.wanted:
            self._learn(stored.wanted)
            stored.wanted = set()
            found = [stored[piece] if ids is None else ids for piece, ids in zip(pieces, found)]
        return b"".join(found) + tail

    def _store(self) -> _Store:
        """The store; a full one becomes the older half of a new one.

        The new one takes over what is met again: the frequent pieces stay, and at most two fillings
        and the pieces of one text are held.
        """
        if len(self.stored) > STORED_PIECES:
            self.stored.older = {}
            self.stored = _Store(self.stored)
        return self.stored

    def _learn(self, pieces: set[str | tuple[str]]) -> None:
        batch, chars = [], 0
        for piece in pieces:
            if isinstance(piece, tuple):
                bare = piece[0]
                self.stored[piece] = self._word("", bare) if _PLAIN(bare) else self._whole(bare)
                continue
            if _PLAIN(piece):
                self.stored[piece] = self._word(self.blank, piece)
                continue
            if piece[0] == "\n" and _PLAIN(piece, 1):
                self.stored[piece] = self.feed + self._word("", piece[1:])
                continue
            lead = "" if self.drops_space or piece[0] == "\n" else " "
            if MARK in piece or "<|" in piece or piece[-1].isspace():
                self.stored[piece] = self._whole(lead + piece)
                continue
            batch.append((piece, lead + piece))
            chars += len(piece) + 3
            if chars > BATCH_CHARS:
                self._learn_batch(batch)
                batch, chars = [], 0
        if batch:
            self._learn_batch(batch)

    def _learn_batch(self, batch: list[tuple[str, str]]) -> None:
        glue = f" {MARK} " if self.drops_space else MARK
        text = glue.join(spaced for _, spaced in batch)
        ids = np.array(
            self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4"
        )
        cuts = np.flatnonzero(ids == self.mark)
        if len(cuts) != len(batch) - 1:
            # the mark melted into a neighbour: one by one
            for piece, spaced in batch:
                self.stored[piece] = self._whole(spaced)
            return
        data = ids.tobytes()
        starts = [0, *((cuts + 1) * 4).tolist()]
        ends = [*(cuts * 4).tolist(), len(data)]
        for (piece, _), start, end in zip(batch, starts, ends):
            self.stored[piece] = data[start:end]


class _Store(dict):
    """Ids of pieces as they follow a blank, and of ``(piece,)`` as it follows anything else.

    A word with signs behind it is put together from the word and the signs, which is where both
    tokenizers cut, and not held itself. What is known neither here nor in the older filling is
    noted in ``wanted`` and has no ids yet.
    """

    def __init__(self, older: dict):
        super().__init__()
        self[""] = b""
        self.older = older
        self.wanted: set[str | tuple[str]] = set()

    def __missing__(self, piece: str | tuple[str]) -> bytes | None:
        if isinstance(piece, str):
            word = piece.rstrip(SIGNS)
            if len(word) < len(piece) and word and word[-1].isalnum() and "<|" not in word:
                ids, signs = self[word], self[(piece[len(word) :],)]
                return None if ids is None or signs is None else ids + signs
        ids = self.older.get(piece)
        if ids is None:
            self.wanted.add(piece)
        else:
            self[piece] = ids
        return ids


_PLAIN = re.compile(f"[{LETTERS}]+").fullmatch
# A blank or line feed followed by white space: the run would be cut in two.
_UNSAFE = re.compile(r"[ \n]\s").search
