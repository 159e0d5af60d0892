"""Token ids in seekable zstandard files, one frame per document.

A file holds, in ascending doc_id order: a skippable frame with a JSON header,
one independent zstandard frame per document with its ids as little-endian
integers, a skippable frame with the documents' ids, and the trailing seek table
of the zstandard seekable format: compressed size, decompressed size and checksum
of every frame before it. A reader finds a document by the last two and
decompresses nothing else; the checksum (low 32 bits of XXH64 over the ids' bytes) is
verified for each frame read.

Byte-level BPE ids of a text are those of its words, each led by its space or line
end, one after another as long as no two white-space characters meet and no added
token such as ``<|endoftext|>`` occurs, so such texts are looked up word by word and
the library encodes each distinct word once per worker; all other texts are encoded
whole, and added tokens get their own ids, as by the library's default.

Files go below the shared folder through pyarrow's file systems, which name local
paths and object stores alike. Every attempt of a task writes a file of its own
and only files named by a finished task enter the manifest, so lost executors and
repeated tasks leave no wrong data.

Edge cases: a null or empty text has only the end id; equal doc_ids are kept,
ordered by text, null doc_ids come first and are read back as null; an empty table
gives an empty manifest. Other columns are ignored.
"""

import itertools
import json
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.llm.common import scratch, stored

# Fixed values of the zstandard seekable format.
SKIPPABLE, SEEK_TABLE, SEEKABLE_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
NO_ID = -(2**63)  # stands for a null doc_id in the files
CACHED_WORDS = 800_000

_encoders = {}


class Encoder:
    """Ids of texts as bytes; words met before are not encoded again.

    ``recent`` and ``older`` hold at most ``CACHED_WORDS`` words each: when the
    first is full it takes the place of the second, so frequent words stay.
    """

    def __init__(self, path, dtype):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype, self.recent, self.older, self.tails, self.heads = dtype, {}, {}, {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.leads = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose bytes begin with a space
        self.leads[[i for token, i in vocabulary.items() if token[0] == "\u0120"]] = True
        self.line = self._ids("\n")[0]

    def _ids(self, text):
        # The batch call gives the same ids and leaves out the offsets.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def _cut(self, text, leads):
        """Bytes of the words of a text, each beginning with an id of ``leads``."""
        ids = self._ids(text)
        width = np.dtype(self.dtype).itemsize
        cuts = (np.flatnonzero(leads(ids)) * width).tolist()
        data = ids.astype(self.dtype).tobytes()
        return [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]

    def _words(self, words):
        """Each word with its bytes: with its line end if it begins with one, else with a space before it."""
        lined = [w for w in words if w[:1] == "\n" and len(w) > 1]  # a line end alone would join the next one
        spaced = [w for w in words if w[:1] != "\n"]
        if spaced:
            yield from zip(spaced, self._cut(" " + " ".join(spaced), lambda ids: self.leads[ids]))
        if lined:
            yield from zip(lined, self._cut("".join(lined), lambda ids: ids == self.line))
        if "\n" in words:
            yield "\n", self._ids("\n").astype(self.dtype).tobytes()

    def _learn(self, words):
        """Add new words. Signs after a letter or digit are a token group of their own."""
        recent, tails = self.recent, self.tails
        whole, parts = [], []
        for word in words:
            stem = word.rstrip(_SIGNS)
            if len(stem) < len(word) and stem[-1:].isalnum():
                parts.append((word, stem, word[len(stem) :]))
            else:
                whole.append(word)
        new = {stem for _, stem, _ in parts}.difference(recent)
        new.update(whole)
        recent.update(self._words(list(new)))
        for tail in {t for _, _, t in parts}.difference(tails):
            tails[tail] = self._ids(tail).astype(self.dtype).tobytes()
        for word, stem, tail in parts:
            recent[word] = recent[stem] + tails[tail]
        if len(tails) > CACHED_WORDS:
            tails.clear()

    def _is_whole(self, text):
        """Whether words of the text must not be encoded alone."""
        return _MEETING.search(text) is not None or any(token in text for token in self.added)

    def _add(self, words):
        """Have words that are not in ``recent`` there, from ``older`` if they were met before."""
        recent, older, new = self.recent, self.older, []
        for word in words:
            known = older.get(word)
            if known is None:
                new.append(word)
            else:
                recent[word] = known
        if new:
            self._learn(new)

    def _head(self, word):
        """Bytes of the first word of a text, which has no space before it."""
        head = self.heads.get(word)
        if head is None:
            if len(self.heads) >= CACHED_WORDS:
                self.heads.clear()
            head = self.heads[word] = self._ids(word).astype(self.dtype).tobytes() if word else b""
        return head

    def encode(self, texts):
        """One byte string per text."""
        get, done, gaps, missing = self.recent.get, [], [], set()
        for k, text in enumerate(texts):
            if self._is_whole(text):
                done.append(self._ids(text).astype(self.dtype).tobytes())
                continue
            words = text.replace("\n", " \n").split(" ")
            parts = list(map(get, words))
            parts[0] = self._head(words[0])
            try:
                done.append(b"".join(parts))
            except TypeError:  # a word not met before
                places = [i for i, part in enumerate(parts) if part is None]
                missing.update([words[i] for i in places])
                gaps.append((k, words, parts, places))
                done.append(None)
        if gaps:
            self._add(missing)
            recent = self.recent
            for k, words, parts, places in gaps:
                for i in places:
                    parts[i] = recent[words[i]]
                done[k] = b"".join(parts)
        if len(self.recent) > CACHED_WORDS:
            self.recent, self.older = {}, self.recent
        return done


_SIGNS = ".,;:!?)|%*#&$\""
# White space after white space.
_MEETING = re.compile(r"\s\s")


def encoder(path, dtype):
    """The encoder of this worker."""
    if (path, dtype) not in _encoders:
        _encoders[path, dtype] = Encoder(path, dtype)
    return _encoders[path, dtype]


def _skippable(magic, data):
    return struct.pack("<II", magic, len(data)) + data


def _checksum(data):
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def write_file(out, documents, dtype, level=3):
    """Write (doc_id, ids as bytes) in order to a binary stream; return documents and ids."""
    import zstandard

    press = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
    header = _skippable(SKIPPABLE, json.dumps({"dtype": dtype}).encode())
    out.write(header)
    seeks, ids, total = [struct.pack("<III", len(header), 0, 0)], [], 0
    for doc_id, data in documents:
        frame = press.compress(data)
        out.write(frame)
        seeks.append(struct.pack("<III", len(frame), len(data), _checksum(data)))
        ids.append(NO_ID if doc_id is None else doc_id)
        total += len(data) // np.dtype(dtype).itemsize
    # A skippable frame holds less than 4 GB, that is 500 million documents.
    index = _skippable(SKIPPABLE, np.array(ids, "<i8").tobytes())
    out.write(index)
    seeks.append(struct.pack("<III", len(index), 0, 0))
    footer = struct.pack("<IBI", len(seeks), 0x80, SEEKABLE_END)
    out.write(_skippable(SEEK_TABLE, b"".join(seeks) + footer))
    return len(ids), total


class TokenFile:
    """Reads the documents of one file by their place in it; ``source`` can seek."""

    def __init__(self, source):
        import zstandard

        self.source, self.press = source, zstandard.ZstdDecompressor()
        end = source.seek(0, 2)
        count, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_END or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end")
        table = self._at(end - 9 - 12 * count, 12 * count)
        self.sizes = np.frombuffer(table, "<u4").reshape(count, 3).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))
        self.dtype = json.loads(self._at(8, self.sizes[0, 0] - 8))["dtype"]
        self.doc_ids = np.frombuffer(self._at(self.starts[count - 1] + 8, self.sizes[-1, 0] - 8), "<i8")

    def _at(self, start, size):
        self.source.seek(int(start))
        return self.source.read(int(size))

    def read(self, place):
        """Ids of the document at a place; only its frame is decompressed."""
        size, plain, checksum = self.sizes[place + 1]
        data = self.press.decompress(self._at(self.starts[place + 1], size), max_output_size=int(plain) or 1)
        if len(data) != plain or _checksum(data) != checksum:
            raise ValueError(f"frame {place} is damaged")
        return np.frombuffer(data, self.dtype)

    def find(self, doc_id):
        """Ids of every document with this doc_id."""
        start, end = np.searchsorted(self.doc_ids, [doc_id, doc_id + 1])
        return [self.read(place) for place in range(start, end)]


def open_uri(uri, mode):
    """A stream on a local path or any store that pyarrow knows."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + os.path.abspath(uri)
    store, path = fs.FileSystem.from_uri(uri)
    if mode == "rb":
        return store.open_input_file(path)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None)  # else the suffix decides


def write_tokens(docs, tokenizer_path, end_id, folder=None, dtype="<u2", n_files=None):
    """Encode all texts into files of ascending doc_id; return their manifest.

    The manifest has a row per file: file, place (the files' order), n_docs and
    n_tokens. ``dtype`` must hold every id; ``n_files`` defaults to the number of
    shuffle partitions.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    n_files = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches):
        from pyspark import TaskContext

        place = TaskContext.get().partitionId()
        tail = np.array([end_id], dtype).tobytes()
        coder = encoder(tokenizer_path, dtype)

        def documents(first):
            for batch in itertools.chain([first], batches):
                ids = batch.column(0).to_pylist()
                for start in range(0, len(ids), 256):
                    texts = [t or "" for t in batch.column(1).slice(start, 256).to_pylist()]
                    yield from zip(ids[start : start + 256], (data + tail for data in coder.encode(texts)))

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        uri = f"{folder}/part-{place:06d}-{uuid.uuid4().hex}.zst"
        with open_uri(uri, "wb") as out:
            n_docs, n_tokens = write_file(out, documents(first), dtype)
        yield pa.RecordBatch.from_pydict(
            {"file": [uri], "place": pa.array([place], pa.int32()), "n_docs": [n_docs], "n_tokens": [n_tokens]}
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange(n_files, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(write, "file string, place int, n_docs long, n_tokens long"), "token_manifest")


def read_tokens(manifest, digest=None, schema="doc_id long, ids array<long>"):
    """Every document of the files of a manifest, read from their frames.

    ``digest`` turns (doc_id, file_start, start, ids) into a row of ``schema``:
    file_start counts the ids in the files before, start those before it in its
    own. By default a row has the doc_id and the ids.
    """
    digest = digest or (lambda doc_id, file_start, start, ids: (doc_id, ids.tolist()))
    before = W.orderBy("place").rowsBetween(W.unboundedPreceding, -1)  # one row a file
    starts = manifest.withColumn("file_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches):
        for batch in batches:
            for uri, file_start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_uri(uri, "rb") as source:
                    file, rows, start, held = TokenFile(source), [], 0, 0
                    for place, doc_id in enumerate(file.doc_ids.tolist()):
                        ids = file.read(place)
                        rows.append(digest(None if doc_id == NO_ID else doc_id, file_start, start, ids))
                        start += len(ids)
                        held += len(ids)
                        if held > 1_000_000 or len(rows) == 10_000:
                            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))

    n_files = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = starts.select("file", "file_start").repartition(n_files, "file")
    return spread.mapInArrow(read, schema)


def token_digests(manifest):
    """Per document, from the files: start, n_tokens and ids_crc32."""
    def row(doc_id, file_start, start, ids):
        return doc_id, file_start + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    return read_tokens(manifest, row, "doc_id long, start long, n_tokens long, ids_crc32 long")
