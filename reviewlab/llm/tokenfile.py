"""Token ids of a corpus in Simple-8b shard files, in ascending order of document id.

Documents are range-partitioned and sorted by id; each task encodes its range with
the tokenizers library and writes shards of about ``SHARD_IDS`` ids.  The library
is called once for each distinct word a worker meets (``WORDS`` are kept at most, then
it starts again): the tokenizer drops white space and never joins what a space parts,
so a text's ids are those of its words one after the other.  Texts that hold "<|",
the start of special tokens, go through the library whole.

Defined results: null and empty texts have only the end id; a null document id sorts
first; documents with an equal id follow each other in no fixed order; an empty table
writes no shards.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm import simple8b
from reviewlab.llm.storage import file_system, in_batches, scratch_dir, stash
from reviewlab.llm.workercache import kept

SHARD_IDS = 4 << 20
WORDS = 700_000
END_ID = 1
#: Words that normalisation leaves one piece: ASCII and Latin-1 letters.
PLAIN = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")


class Words:
    """A tokenizer file that drops white space, asked word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._known: dict[str, bytes] = {}

        ends = self.library.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(1 + max(ends.values()), bool)
        self._ends[[i for word, i in ends.items() if word.endswith("</w>")]] = True

    def _ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _ask_plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters only: each is one piece, whose last id ends a word, so
        many words can be asked for as one text."""
        groups = [words[i:i + 256] for i in range(0, len(words), 256)]
        out = []
        for group, e in zip(groups, self.library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = (np.flatnonzero(self._ends[ids]) + 1).tolist()
            if len(ends) != len(group):
                raise ValueError(f"{len(group)} words gave {len(ends)} pieces")
            flat = ids.tobytes()
            out += [flat[4 * a:4 * b] for a, b in zip([0, *ends], ends)]
        return out

    def _learn(self, new: list[str]) -> None:
        known = self._known
        bare = {w: w[:-1] if len(w) > 1 and w[-1] in ".,;:!?" and w[-2].isascii() and w[-2].isalpha() else w for w in new}
        # after an ASCII letter a last sign is a piece of its own
        ask = {x for x in bare.values() if x not in known} | {x for x in ".,;:!?" if x not in known}
        plain = [w for w in ask if PLAIN.fullmatch(w)]
        known.update(zip(plain, self._ask_plain(plain)))
        other = [w for w in ask if w not in known]
        known.update(zip(other, self._ask(other)))
        for w, stem in bare.items():
            if w not in known:
                known[w] = known[stem] + known[w[-1]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        known = self._known
        if len(known) > WORDS:
            known.clear()
        known[""] = b""
        words: list[list[str] | None] = []
        for text in texts:
            text = text or ""
            if "<|" in text:
                words.append(None)
            else:
                words.append((text.lower() if text.isascii() else text).replace("\n", " ").split(" "))
        met: set[str] = set()
        met.update(*(own for own in words if own is not None))
        self._learn([w for w in met if w not in known])
        return [self._ask([text])[0] if own is None else b"".join(map(known.__getitem__, own)) for text, own in zip(texts, words)]


def write(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """(part, number, file, n_docs, n_ids): the shards, in the order of their documents by (part, number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept(("words", path), lambda: Words(path)) as words:
            yield from written(batches, words)

    def written(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        end = np.array([end_id], "<u4").tobytes()
        docs_, counts, held, size = [], [], [], 0

        def shard() -> pa.RecordBatch:
            nonlocal number, size
            # a name of this attempt's own: what counts is the table of names that Spark commits
            file = f"{folder}/ids-{part:06d}-{number:06d}-{uuid.uuid4().hex}.s8b"
            ids = np.frombuffer(b"".join(held), "<u4").astype(np.uint64)
            with fs.open_output_stream(file_system(file)[1], compression=None) as sink:
                simple8b.write_shard(sink, docs_, counts, ids)
            out = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                                              "file": [file], "n_docs": [len(docs_)], "n_ids": [len(ids)]})
            for x in (docs_, counts, held):
                x.clear()
            number, size = number + 1, 0
            return out

        for batch in batches:
            for lo in range(0, len(batch), 256):
                some = batch.slice(lo, 256)
                for doc, ids in zip(some.column(0).to_pylist(), words.encode(some.column(1).to_pylist())):
                    ids += end
                    docs_.append(doc)
                    counts.append(len(ids) // 4)
                    held.append(ids)
                    size += len(ids) // 4
                    if size >= shard_ids:
                        yield shard()
        if docs_:
            yield shard()

    rows = in_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id")
    return stash(ordered.mapInArrow(run, "part int, number int, file string, n_docs long, n_ids long"), "token-shards")


def read(shards: DataFrame, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32[, ids]) of every document, from the files."""
    # one row a shard: its first id's place in the corpus
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = stash(shards.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")), "token-starts")
    extra = ", ids binary" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = file_system(file)
                with fs.open_input_file(path) as f:
                    shard, at, out = simple8b.Shard(f), 0, []
                    for doc, n in zip(shard.doc_ids, shard.counts.tolist()):
                        ids = shard.ids(at, n).astype("<u4").tobytes()
                        out.append((doc, start + at, n, zlib.crc32(ids), ids if with_ids else None))
                        at += n
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())[:5 if with_ids else 4]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)],
                                                 names=["id", "start", "n_tokens", "ids_crc32", "ids"][:len(kinds)])

    n = placed.count()
    return placed.repartition(max(1, n)).mapInArrow(
        run, f"id long, start long, n_tokens long, ids_crc32 long{extra}").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", **options) -> DataFrame:
    """Write the corpus' shards in the shared folder and read every document's row back."""
    return read(write(docs, path, scratch_dir(docs.sparkSession, "tokens"), id_col, **options), id_col)
