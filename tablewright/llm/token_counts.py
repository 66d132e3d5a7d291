"""Token counts: strings that are one token on their own are counted directly; only the others are merged.

For a tokenizer whose merges stop at the ends of pre-tokens, prove_whole_tokens() finds, before any text is read, which
entries of the vocabulary come out as one token when they stand alone as a pre-token. In a text, pre-tokens on that list
count one; the library's merges run for the rest only. As white space always ends a pre-token here, the count of what
stands between white space is kept, so a word that returns costs one look-up.

Whether a tokenizer's file is of that kind is read from it; texts of any other one are encoded whole.

Each row is counted on its own: nothing is shuffled, and the tokenizer's file and the list have a fixed size.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

OVER = 2048
#: Words whose counts a worker process keeps; beyond this it starts again from the whole tokens.
KEPT_WORDS = 300_000
WORD_END = "</w>"
# The steps of a tokenizer that lower-cases by code point and splits at white space, which it drops.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def counts_by_word(source: str) -> bool:
    """Whether a tokenizer's file gives the same tokens for each word between white space as for the whole text."""
    spec = json.loads(source)
    steps = (spec.get("normalizer") or {}).get("normalizers"), (spec.get("pre_tokenizer") or {}).get("pretokenizers")
    model = spec["model"]
    plain = model.get("type") == "BPE" and model.get("end_of_word_suffix") == WORD_END and not model.get("dropout") and not model.get("continuing_subword_prefix")
    apart = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or any(c.isspace() for c in t["content"])) for t in spec.get("added_tokens", []))
    return steps == (NORMALIZERS, SPLITS) and plain and apart


def prove_whole_tokens(tokenizer: Tokenizer) -> dict[str, int]:
    """Vocabulary entries that end a word, without the mark, which the model gives back as the one token that they are."""
    found = {}
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if entry.endswith(WORD_END) and (bare := entry[: -len(WORD_END)]):
            tokens = tokenizer.model.tokenize(bare)
            if len(tokens) == 1 and tokens[0].id == number:
                found[bare] = 1
    return found


class Counts(dict):
    """Bytes of a word between white space to its number of tokens; counts a word when it is first asked for."""

    def __init__(self, tokenizer: Tokenizer, whole: dict[str, int]):
        super().__init__()
        self.tokenizer, self.whole = tokenizer, whole
        self.specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.merged = tokenizer.model.tokenize
        self.start()

    def start(self) -> None:
        self.clear()
        self.update((w.encode(), 1) for w in self.whole if w.isascii() and w.isalpha())

    def pre_token(self, piece: str) -> int:
        return 1 if piece in self.whole else len(self.merged(piece))

    def __missing__(self, word: bytes) -> int:
        text = word.decode()
        if any(s in text for s in self.specials):
            n = len(self.tokenizer.encode(text, add_special_tokens=False))
        elif text.isascii() and text.isalpha():
            n = self.pre_token(text.lower())
        else:
            plain = self.tokenizer.normalizer.normalize_str(text)
            n = sum(self.pre_token(piece) for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain))
        self[word] = n
        return n

    def of(self, text: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.start()
        return sum(map(self.__getitem__, text.split()))


class Whole:
    """Counts of texts that are encoded whole."""

    def __init__(self, tokenizer: Tokenizer):
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.tokenizer = tokenizer

    def of(self, text: bytes) -> int:
        return len(self.tokenizer.encode(text.decode(), add_special_tokens=False))


def token_counts(documents: DataFrame, tokenizer_file: str, over: int = OVER) -> DataFrame:
    """For each row of documents (doc_id, text): n_bytes in UTF-8, n_tokens and over_limit (n_tokens > over).

    Counts are those of the library for the whole text, without begin, end or added special tokens; special strings in
    a text are tokens, as is its default; nothing is truncated or padded. A null text is empty: no bytes, no tokens.
    Repeated rows give repeated results; other columns are ignored.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        source = file.read()
    tokenizer = Tokenizer.from_str(source)
    by_word = counts_by_word(source)
    given = documents.sparkSession.sparkContext.broadcast((source, prove_whole_tokens(tokenizer) if by_word else {}))
    kept: list[Counts | Whole] = []

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            own = Tokenizer.from_str(given.value[0])
            kept.append(Counts(own, given.value[1]) if by_word else Whole(own))
        counts = kept[0]
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            tokens = pa.array([counts.of(t) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) if t else 0 for t in texts], pa.int64()), tokens], names=["doc_id", "n_bytes", "n_tokens"])

    df = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return df.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > over)
