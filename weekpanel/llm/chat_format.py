"""Chat formatting at token level.

A turn is rendered as ``### Role: text</turn>\\n``. Role and text are encoded
as segments of their own; the marks around them are reserved ids outside the
tokenizer's vocabulary, so no text can produce them. In the rendered string
the same holds by escaping: a backslash goes before every backslash, every
``#`` that begins ``###`` and every ``<`` that begins ``</turn>`` (in a role
also before ``:``), and unescaping drops one backslash before any character.

Segments are encoded row by row before the shuffle. Conversations are then
assembled by a sorted stream over each partition in parts of bounded size, so
neither one long conversation nor one partition has to fit into memory. The loss mask of a part
comes from prefix sums over segment lengths."""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the public pre-tokenization pattern that goes with this vocabulary
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
MARKS = ("### ", ": ", "</turn>\n")  # reserved ids follow the vocabulary in this order
ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
NAMES = {v: k for k, v in ROLES.items()}
LOSS_ROLES = ("assistant",)
PART_TOKENS = 1 << 17

ENCODED = "conv_id long, turn long, body binary, n_role int, loss boolean"
FORMATTED = "conv_id long, part long, n_turns int, input_ids array<int>, loss_mask array<tinyint>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_IN_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_IN_ROLE = re.compile(r"\\|#(?=##)|<(?=/turn>)|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _IN_TEXT.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def show_role(role: str) -> str:
    """Known roles by name; any other role verbatim behind ``=``."""
    return ROLES.get(role) or "=" + _IN_ROLE.sub(lambda m: "\\" + m[0], role)


def read_role(shown: str) -> str:
    return NAMES[shown] if shown in NAMES else unescape(shown[1:])


class Codec:
    """Tokenizer plus the reserved ids."""

    def __init__(self, vocabulary: str):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.start, self.sep, self.end = (max(ranks.values()) + 2 + i for i in range(3))  # one id is left free for an end of text

    def segment(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), np.int32)

    def text(self, ids) -> str:
        return self.encoding.decode_bytes(ids.tolist()).decode("utf-8")

    def turns(self, ids: np.ndarray, mask: np.ndarray):
        """(shown role, escaped text, escaped text under the mask) of every turn."""
        starts, seps, ends = (np.flatnonzero(ids == i) for i in (self.start, self.sep, self.end))
        for a, b, c in zip(starts, seps, ends, strict=True):
            body, on = ids[b + 1 : c], mask[b + 1 : c].astype(bool)
            yield self.text(ids[a + 1 : b]), self.text(body), self.text(body[on]) if on.any() else ""


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def loss_mask(lengths: np.ndarray, loss: np.ndarray) -> np.ndarray:
    """Mask over the tokens of segments with these lengths: +1 where a loss
    segment starts, -1 where it ends, summed up."""
    ends = np.cumsum(lengths)
    step = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int32)
    np.add.at(step, (ends - lengths)[loss], 1)
    np.add.at(step, ends[loss], -1)
    return np.cumsum(step)[:-1].astype(np.int8)


def _encode(vocabulary: str, loss_roles: tuple):
    def run(batches):
        c = codec(vocabulary)
        for batch in batches:
            bodies, n_role, loss = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                role = role or ""
                r, t = c.segment(show_role(role)), c.segment(escape(text or ""))
                bodies.append(np.concatenate((r, t)).tobytes())
                n_role.append(len(r))
                loss.append(role in loss_roles)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(bodies, pa.binary()), pa.array(n_role, pa.int32()), pa.array(loss, pa.bool_())],
                ["conv_id", "turn", "body", "n_role", "loss"])

    return run


def _assemble(vocabulary: str, part_tokens: int):
    """Sorted turns in, parts of conversations out."""

    def run(batches):
        c = codec(vocabulary)
        done: list = []  # parts not yet sent
        state = {"conv": None, "part": 0, "open": False}
        pieces, lengths, loss, turns, size = [], [], [], 0, 0

        def close():
            nonlocal pieces, lengths, loss, turns, size
            if turns:
                done.append((state["conv"], state["part"], turns, np.concatenate(pieces), loss_mask(np.array(lengths), np.array(loss))))
                state["part"] += 1
            pieces, lengths, loss, turns, size = [], [], [], 0, 0

        def sent():
            out = pa.RecordBatch.from_arrays([
                pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int32()),
                pa.array([d[3] for d in done], pa.list_(pa.int32())), pa.array([d[4] for d in done], pa.list_(pa.int8()))],
                ["conv_id", "part", "n_turns", "input_ids", "loss_mask"])
            done.clear()
            return out

        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("conv_id", "body", "n_role", "loss")), strict=True)
            for conv, body, n_role, is_loss in rows:
                if not state["open"] or conv != state["conv"]:
                    close()
                    state.update(conv=conv, part=0, open=True)
                elif size >= part_tokens:
                    close()
                ids = np.frombuffer(body, np.int32)
                role, text = ids[:n_role], ids[n_role:]
                pieces += [np.array([c.start], np.int32), role, np.array([c.sep], np.int32), text, np.array([c.end], np.int32)]
                lengths += [1, len(role), 1, len(text), 1]
                loss += [False, False, False, is_loss, False]
                turns += 1
                size += len(ids) + 3
            if sum(len(d[3]) for d in done) >= part_tokens:
                yield sent()
        close()
        if done:
            yield sent()

    return run


def format_chats(turns: DataFrame, vocabulary: str = VOCABULARY, loss_roles: tuple = LOSS_ROLES, part_tokens: int = PART_TOKENS) -> DataFrame:
    """(conv_id, part, n_turns, input_ids, loss_mask) of rows (conv_id, turn, role, text).

    Turns stand in order of turn (null first), ties by their encoded role and
    text, so repeated rows are kept and reruns agree. A conversation longer
    than ``part_tokens`` continues in further parts, each of whole turns. Null role and null text are
    empty; a null conv_id is a conversation of its own. Other columns are ignored. Empty table: no
    rows. ``vocabulary`` must be readable at the same path on every executor."""
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    encoded = rows.mapInArrow(_encode(vocabulary, tuple(loss_roles)), ENCODED)
    ordered = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "body")
    return ordered.mapInArrow(_assemble(vocabulary, part_tokens), FORMATTED)


def _read(vocabulary: str):
    def run(batches):
        c = codec(vocabulary)
        conv, state, rows = None, None, []

        def close():
            if state:
                rows.append((conv, state["n"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["shown"]))

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("part")[i].as_py() == 0:
                    close()
                    conv, state = batch.column("conv_id")[i].as_py(), {"n": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "shown": 0}
                ids, mask = (np.asarray(batch.column(n)[i].values) for n in ("input_ids", "loss_mask"))
                for shown, body, masked in c.turns(ids, mask):
                    state["n"] += 1
                    state["all"].update(f"{read_role(shown)}\n{unescape(body)}\n".encode())
                    under = unescape(masked)
                    state["chars"] += len(under)
                    state["loss"].update(under.encode())
                    state["shown"] += len(shown) + len(body) + sum(map(len, MARKS))
            if rows:
                yield _digest_batch(rows)
                rows = []
        close()
        if rows:
            yield _digest_batch(rows)

    return run


def _digest_batch(rows):
    cols = list(zip(*rows, strict=True))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in DIGESTS.split(", ")])


def read_back(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Digests of conversations, from formatted ids and masks alone.

    The parts of a conversation must follow each other in one partition, as
    ``format_chats`` leaves them; parts read from storage are sorted first
    (``repartition("conv_id").sortWithinPartitions("conv_id", "part")``)."""
    return formatted.mapInArrow(_read(vocabulary), DIGESTS)
