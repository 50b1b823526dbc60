"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Patterns (kind ``assign``, ``access``, ``hex``) are matched leftmost and without overlap per kind, and matches that are too short are
dropped afterwards. The method looks at every other run of ``MIN_RUN`` or more key characters: a first-order Markov model of
random strings and one of ordinary identifiers each give its log-likelihood, and a run is a span of kind ``markov`` if it mixes
letters and digits and the log-likelihood ratio per character is above the model's threshold.

The models are learnt from labelled samples: values the patterns found stand for random strings, words of the same texts
outside any pattern for identifiers. Both are counted by Spark over about ``max_texts`` texts (a documented bound, by a draw
of each row's own); ``PRIOR`` labelled strings of each kind, drawn from a fixed seed, join either: random strings of several alphabets,
and identifiers, paths and dated names made of ``WORDS``. So the models are defined without matches. The threshold is chosen on
a labelled holdout of such strings from another seed: the least one at which at most ``ALARMS`` of what is found is ordinary.

Null texts are empty and have no spans. Repeated rows give repeated rows. An empty table gives no rows. Offsets are code
points, ends exclusive. Other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import with_row_draw

# Fixed values of the contract.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so a shorter one never holds a longer
KEYWORDS = ("passw", "secret", "token", "api")

MIN_RUN = 16
MIN_RATIO = 1.0  # no threshold is lower
ALARMS = 0.01
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
WORD = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
CODE = np.full(128, -1, np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
EDGE = len(ALPHABET)
PRIOR = 500
SALT = 7101


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, in contract order."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return in_order(spans)


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2]), span[1]))


def untouched(matches, taken: list[tuple[int, int]]) -> list:
    """The matches, in order, that no span of ``taken`` touches; both are swept once."""
    joined: list[list[int]] = []
    for start, end in sorted(taken):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    free, at = [], 0
    for match in matches:
        while at < len(joined) and joined[at][1] <= match.start():
            at += 1
        if at == len(joined) or joined[at][0] >= match.end():
            free.append(match)
    return free


def _pairs(value: str) -> np.ndarray:
    """Transitions of a value, edges included, as places in the flat model."""
    codes = np.concatenate([[EDGE], CODE[np.frombuffer(value.encode("ascii"), np.uint8)], [EDGE]])
    return codes[:-1] * (EDGE + 1) + codes[1:]


#: What ordinary identifiers are made of.
WORDS = (
    "account action address amount array base batch block body branch button cache card category change channel child city class client code column "
    "command comment config content context count country customer data date default delete detail device document domain email entry error event "
    "field file filter flag folder form format group handler header height home host image index input instance item job key label language length "
    "level line link list load local location log manager map mark master member message method mode model module month name network node note "
    "number object offset option order output owner page parent part password path payment person phone place point policy port position post "
    "price process product profile project property public query queue range rate record region report request resource response result role root "
    "row rule run sample schema screen section select sender server service session setting shape size source stage start state status step stock "
    "store stream string style summary system table tag target task team template test text thread time title total track type unit update user "
    "value vendor version video view volume week width window worker year zone"
).split()


def seeds(salt: int = SALT) -> list[str]:
    """Labelled random strings."""
    draw = random.Random(salt)
    alphabets = (string.hexdigits[:16], string.ascii_letters + string.digits, ALPHABET, string.ascii_uppercase + string.digits)
    return ["".join(draw.choices(letters, k=draw.randint(20, 40))) for letters in alphabets for _ in range(PRIOR)]


def ordinary(salt: int = SALT) -> list[str]:
    """Labelled identifiers, paths, and names with numbers and dates."""
    draw = random.Random(salt)
    found = []
    for _ in range(PRIOR):
        some = draw.choices(WORDS, k=draw.randint(3, 6))
        found += [
            "_".join(some) + f"_{draw.randrange(1000)}",
            some[0] + "".join(word.title() for word in some[1:]) + str(draw.randrange(10_000)),
            "/".join(some) + f"/v{draw.randrange(20)}",
            "-".join(some) + f"-{draw.randrange(1990, 2040)}-{draw.randrange(1, 13):02d}-{draw.randrange(1, 29):02d}",
            "".join(word.title() for word in some) + f"V{draw.randrange(10)}",
            "_".join(some).upper() + f"_{draw.randrange(100)}",
        ]
    return found


class Model(NamedTuple):
    """The log-likelihood ratio of each transition, random against ordinary, as an array of (alphabet + edge) squared; and the threshold."""

    ratio: np.ndarray
    at_least: float


def per_character(value: str, ratio: np.ndarray) -> float:
    return ratio[_pairs(value)].sum() / len(value)


def threshold(ratio: np.ndarray) -> float:
    """The least ratio at which ordinary strings are at most ``ALARMS`` of the holdout's strings above it."""
    high = np.sort([per_character(value, ratio) for value in seeds(SALT + 1)])
    low = np.sort([per_character(value, ratio) for value in ordinary(SALT + 1)])
    for at in np.concatenate([[MIN_RATIO], low[low > MIN_RATIO]]):
        alarms, hits = (low > at).sum(), (high > at).sum()
        if alarms <= ALARMS * (alarms + hits):
            break
    return float(at)


def fit(documents: DataFrame, max_texts: int = 20_000) -> Model:
    """Both models, as their ratio, and the threshold, from texts of ``documents`` and the labelled strings."""
    n = documents.count()
    cells = (EDGE + 1) ** 2

    def count(batches):
        for batch in batches:
            found = np.zeros((2, cells), np.int64)
            for text in batch.column(0).to_pylist():
                spans = base_spans(text or "")
                taken = []
                for start, end, kind in spans:
                    value = ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]
                    value = "".join(c for c in value if c in ALPHABET)
                    np.add.at(found[0], _pairs(value), 1)
                    taken.append((start, end))
                words = untouched(WORD.finditer(text or ""), taken)
                if words:
                    np.add.at(found[1], np.concatenate([_pairs(m[0]) for m in words]), 1)
            model, cell = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(model), pa.array(cell), pa.array(found[model, cell])], names=["model", "cell", "n"])

    chosen = with_row_draw(documents, "_draw", SALT).filter(F.col("_draw") < max_texts / max(1, n))
    counts = chosen.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(count, "model long, cell long, n long")
    table = np.zeros((2, cells))
    for row in counts.groupBy("model", "cell").agg(F.sum("n").alias("n")).collect():  # at most 2 x 68 x 68 rows
        table[row["model"], row["cell"]] = row["n"]
    for model, values in enumerate((seeds(), ordinary())):
        for value in values:
            np.add.at(table[model], _pairs(value), 1)
    table = table.reshape(2, EDGE + 1, EDGE + 1) + 0.5
    chance = np.log(table / table.sum(axis=2, keepdims=True))
    ratio = (chance[0] - chance[1]).ravel()
    return Model(ratio, threshold(ratio))


def markov_spans(text: str, model: Model, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Runs more likely random than ordinary that no span of ``taken`` touches."""
    spans = []
    for match in untouched(RUN.finditer(text), [(start, end) for start, end, _ in taken]):
        value = match[0]
        if not any(c.isdigit() for c in value) or value.isdigit() or not any(c.isalpha() for c in value):
            continue
        if per_character(value, model.ratio) > model.at_least:
            spans.append((match.start(), match.end(), "markov"))
    return spans


def _text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, counts per base kind, n_markov, base_sha256 and spans of every document."""

    def find(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base = base_spans(text)
                more = markov_spans(text, model, base)
                kinds = [kind for _, _, kind in base]
                digest = hashlib.sha256(_text(base).encode()).hexdigest()
                rows.append((doc_id, kinds.count("assign"), kinds.count("access"), kinds.count("hex"), len(more), digest, _text(in_order(base + more))))
            names = ["doc_id", "n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"]
            types = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)], names=names)

    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return given.mapInArrow(find, "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string")


def redacted(text: Column, model: Model, mark: str = "<secret>") -> Column:
    """The text with every span replaced by ``mark``; spans that overlap are replaced as one. Null stays null."""

    @F.pandas_udf("string")
    def replace(batch: pd.Series) -> pd.Series:
        return batch.map(lambda text: None if text is None else cut_out(text, model, mark))

    return replace(text.cast("string"))


def cut_out(text: str, model: Model, mark: str) -> str:
    base = base_spans(text)
    out, done = [], 0
    for start, end, _ in sorted(base + markov_spans(text, model, base)):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


def redact(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with secrets taken out of ``text``, and ``n_chars``, if there, following texts that changed."""
    row = [F.col(f"`{name}`") for name in documents.columns]
    held = documents.select(F.struct(*row).alias("_row"), redacted(F.col("text"), model).alias("_text"))
    changed = ~F.col("_text").eqNullSafe(F.col("_row.text"))
    out = []
    for name in documents.columns:
        value = F.col(f"_row.`{name}`")
        if name == "text":
            value = F.col("_text")
        elif name == "n_chars":
            value = F.when(changed, F.char_length("_text").cast(documents.schema[name].dataType)).otherwise(value)
        out.append(value.alias(name))
    return held.select(*out)
