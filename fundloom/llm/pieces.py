"""Piece encoding and decoding as the sentencepiece library does it for models that merge pairs by score.

Of every prefix of a text only the last token of its encoding is stored. It is unique: of the tokens that end at a place,
found by an automaton over all pieces, exactly one fits to the last token of the prefix before it. Two tokens fit if
merging their characters alone gives these two tokens again; a sequence is the encoding of its text if and only if all
neighbours in it fit, because merges are chosen by score and then from the left, which leaving out the rest of the text
does not change. The ids are then recovered backwards from the whole text's last token.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batches, record, text_of, worker_state

#: The mark that stands for a space, and what the library prints for an unknown piece.
SPACE, UNKNOWN = "▁", " ⁇ "
#: Runs no longer than this are kept with their ids; once so many are kept, those that are not met again go.
KEPT, ROOM = 64, 300_000
#: Pairs of tokens that are kept with whether they fit.
PAIRS = 2_000_000
START = -1
#: Letters, and what is neither a letter nor a space nor a line end.
LETTER, OTHER = r"[^\W\d_²³¹]", rf"(?:(?![^\W\d_²³¹])[^{SPACE}\n])"


def piece_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class _Runs(dict):
    """Ids of what stands between two places that no piece crosses."""

    def __init__(self, owner):
        self.owner, self.before = owner, {}

    def __missing__(self, run: str) -> bytes:
        ids = self.before.get(run)
        if ids is None:
            ids = self.owner.ids_of_run(run).tobytes()
        if len(run) <= KEPT:
            if len(self) >= ROOM:
                self.before = dict(self)
                self.clear()
            self[run] = ids
        return ids


class PieceCoder:
    """Encodes and decodes with the pieces and scores of one model file; ids carry no special tokens unless asked for.

    If no piece of the model goes across them, text is cut before spaces, around line ends and where letters meet other
    characters, and each distinct run is encoded once. A character without a piece of its own becomes its bytes.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.end, self.unknown = model.eos_id(), model.unk_id()
        ids = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in ids]
        byte = [model.is_byte(i) for i in ids]
        silent = [model.is_control(i) for i in ids]
        self.piece = {names[i]: i for i in ids if not (byte[i] or silent[i] or model.is_unknown(i) or model.is_unused(i))}
        self.score = {p: model.get_score(i) for p, i in self.piece.items()}
        self.names, self.size = names, [len(n) for n in names]
        self.byte = {int(names[i][3:-1], 16): i for i in ids if byte[i]}
        if self.byte and len(self.byte) != 256:
            raise ValueError("a model has a piece for every byte or for none")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.piece.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.surface = [UNKNOWN.encode() if model.is_unknown(i) else b"" if silent[i] else bytes([int(names[i][3:-1], 16)]) if byte[i]
                        else names[i].replace(SPACE, " ").encode() for i in ids]
        self.is_byte, self.silent, self.controls = byte, silent, {i for i in ids if silent[i]}
        self.decimal = [str(i) for i in ids]
        # the library's own rules for white space, as far as this class follows them
        self.prefix = SPACE if model.encode("a") != model.encode(" a") and model.decode(model.encode(" a")) == " a" else ""
        self.library = None if model.decode(model.encode(" a  b ")) == " a  b " and self.prefix else model
        apart = re.compile(f"{SPACE}*(?:{LETTER}+|{OTHER}+)?")
        self.runs = re.compile(f"{SPACE}*(?:{LETTER}+|{OTHER}+)|{SPACE}+|\n+") if all(map(apart.fullmatch, self.piece)) else None
        self.known, self.pairs = _Runs(self), {}

    def merged(self, text: str) -> list[str]:
        """The plain way, for short texts: the neighbours whose union has the best score merge, the leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow: ``before`` is a token, START, or -2 - c for a character c without a piece."""
        name = self.names[token]
        head = [] if before == START else [chr(-2 - before) if before < START else self.names[before]]
        found = self.merged("".join(head) + name) == [*head, name]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[before, token] = found
        return found

    def last_tokens(self, run: str) -> list[int]:
        """For each prefix of the run the last token of its encoding; -2 - c where that is a character without a piece."""
        last, known = [None] * (len(run) + 1), self.pairs
        last[0] = START
        for end, (size, token) in self.automaton.iter(run):
            end += 1
            if last[end] is not None:
                continue
            before = last[end - size]
            if before is None:
                before = last[end - size] = -2 - ord(run[end - size - 1])
            fits = known.get((before, token))
            if fits or fits is None and self.fits(before, token):
                last[end] = token
        return [-2 - ord(run[k - 1]) if t is None else t for k, t in enumerate(last)] if None in last else last

    def ids_of_run(self, run: str) -> array:
        last, at, back, size = self.last_tokens(run), len(run), [], self.size
        while at:
            token = last[at]
            if token >= 0:
                back.append(token)
                at -= size[token]
                continue
            # bytes backwards, as everything here
            back.extend([self.byte[b] for b in reversed(chr(-2 - token).encode())] if self.byte else [self.unknown])
            at -= 1
        return array("i", back[::-1])

    def encode(self, text: str, end: bool = False) -> array:
        """The ids of the text, with the end id after them if asked for. An empty text has none of its own."""
        out = array("i")
        if self.library is not None:
            out.extend(self.library.encode(text))
        elif text:
            whole = self.prefix + text.replace(" ", SPACE)
            out.frombytes(b"".join(map(self.known.__getitem__, self.runs.findall(whole) if self.runs else [whole])))
        if end:
            out.append(self.end)
        return out

    def decode(self, ids) -> str:
        """The text of the ids: control pieces are silent, bytes that are no UTF-8 become U+FFFD one by one."""
        if self.library is not None:
            return self.library.decode(list(ids))
        try:
            # a control piece, but for one at the end, parts the bytes on its two sides
            text = b"".join(map(self.surface.__getitem__, ids)).decode() if self.controls.isdisjoint(ids[:-1]) else None
        except UnicodeDecodeError:
            text = None
        if text is None:
            text = "".join(self._spoken(ids))
        first = next((i for i in ids if not self.silent[i]), None)
        return text[1:] if first is not None and not self.is_byte[first] and self.names[first].startswith(SPACE) else text

    def _spoken(self, ids):
        """Pieces of text, byte runs decoded on their own: a byte that begins no whole character is U+FFFD."""
        held = b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                held += self.surface[i]
                continue
            while held:
                for n in (1, 2, 3, 4):
                    try:
                        c = held[:n].decode()
                        break
                    except UnicodeDecodeError:
                        c = ""
                yield c or "�"
                held = held[n if c else 1 :]
            if i is not None:
                yield self.surface[i].decode()


def coder(path: str) -> PieceCoder:
    """The worker's coder for this file."""
    known = worker_state("piece_coders", dict)
    if path not in known:
        known[path] = PieceCoder(path)
    return known[path]


IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def encoded(docs: DataFrame, path: str | None = None, end: bool = True) -> DataFrame:
    """doc_id and ids (array of int) of each row's whole text (doc_id, text; other columns are not read).

    Null texts count as empty and have the end id alone (no id if ``end`` is false); a null doc_id stays null; repeated
    rows and ties come back as often as they go in; an empty table gives an empty table. A text's ids are held at once,
    four bytes each, also where it has no space; nothing is shuffled. ``path`` names the model file, the public one if
    none is given, and must be readable by executors.
    """
    path = path or piece_bpe_path()

    def run(source):
        mine = coder(path)
        for batch in batches(source, 1 << 20):
            yield record(IDS, batch.column(0), [mine.encode(t, end) for t in batch.column(1).to_pylist()])
    return _plain(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of each row of ids (doc_id, ids; other columns are not read); null ids and no ids give an empty text."""
    path = path or piece_bpe_path()

    def run(source):
        mine = coder(path)
        for batch in batches(source, 1 << 20):
            yield record(TEXTS, batch.column(0), [mine.decode(i or ()) for i in batch.column(1).to_pylist()])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens with the end id, and hashes of the ids in decimal and of the text they decode to; rows as in ``encoded``."""
    path = path or piece_bpe_path()

    def run(source):
        mine = coder(path)
        for batch in batches(source, 1 << 20):
            out = []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = mine.encode(text, end=True)
                said = " ".join(map(mine.decimal.__getitem__, ids))
                out.append((d, len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(mine.decode(ids).encode()).hexdigest()))
            yield record(DIGESTS, *(zip(*out) if out else [[]] * 4))
    return _plain(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
