"""Merkle-tree fingerprints of documents over sections, paragraphs and passages.

A text is cut into sections (blank lines between), sections into paragraphs (lines), and
paragraphs into passages (sentences, long ones after every four words). A leaf digest covers
a passage's exact characters, an inner digest its children's digests, so equal roots mean
equal texts. Two trees are compared from the root: equal branches are skipped, and only
differing ones are opened, which locates the edits.

Null text: as empty (a root without children). Repeated rows and ids stay separate rows.
"""
from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_out, texts

_SECTION_END = re.compile(r"\n{2,}")
_PARAGRAPH = re.compile(r"[^\n]*\n+|[^\n]+")
_PASSAGE = re.compile(r"[^.!?]*[.!?]+\s*|[^.!?]+")
_WORDS = re.compile(r"\s*(?:\S+\s*){1,4}|\s+")
LONG_PASSAGE = 24


def _digest(kind: bytes, data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16, person=kind).digest()


def _passages(paragraph: str) -> list[str]:
    out = []
    for passage in _PASSAGE.findall(paragraph):
        out += [passage] if len(passage) <= LONG_PASSAGE else _WORDS.findall(passage)
    return out


def _sections(text: str) -> list[str]:
    """Cut after every run of blank lines."""
    out, at = [], 0
    for m in _SECTION_END.finditer(text):
        out.append(text[at:m.end()])
        at = m.end()
    return out + [text[at:]] if at < len(text) else out


def build(text: str) -> tuple:
    """A node: (digest, length in characters, children); a leaf has no children."""
    sections = []
    for section in _sections(text):
        paragraphs = []
        for paragraph in _PARAGRAPH.findall(section):
            leaves = tuple((_digest(b"leaf", p.encode()), len(p), ()) for p in _passages(paragraph))
            paragraphs.append((_digest(b"paragraph", b"".join(x[0] for x in leaves)),
                               len(paragraph), leaves))
        sections.append((_digest(b"section", b"".join(x[0] for x in paragraphs)),
                         len(section), tuple(paragraphs)))
    return (_digest(b"root", b"".join(x[0] for x in sections)), len(text), tuple(sections))


def _open(nodes: list[tuple]) -> list[tuple]:
    return [c for n in nodes for c in n[2]]


def unmatched(a: tuple, b: tuple) -> tuple[list[tuple], list[tuple]]:
    """Leaves of either tree that have no equal branch in the other one."""
    left, right = [a], [b]
    for _ in range(4):  # root, section, paragraph, passage
        have = Counter(n[0] for n in left) & Counter(n[0] for n in right)
        rest = []
        for nodes in (left, right):
            spare, kept = have.copy(), []
            for n in nodes:
                if spare.get(n[0], 0):
                    spare[n[0]] -= 1
                else:
                    kept.append(n)
            rest.append(kept)
        left, right = rest
        if _ == 3:
            break
        left, right = _open(left), _open(right)
    return left, right


def likeness(a: tuple, b: tuple) -> float:
    """Share of the characters of both texts under branches that the trees share."""
    if a[0] == b[0]:
        return 1.0
    total = a[1] + b[1]
    if not total:
        return 1.0
    left, right = unmatched(a, b)
    return 1.0 - sum(n[1] for n in left + right) / total


def edited_spans(old: str, new: str) -> list[tuple[int, int]]:
    """Character spans of ``new`` whose passages are not in ``old``, joined where they touch."""
    a, b = build(old), build(new)
    have = Counter(n[0] for n in _open(_open(_open([a]))))
    spans, at = [], 0
    for digest, n, _ in _open(_open(_open([b]))):
        if have[digest] > 0:
            have[digest] -= 1
        elif spans and spans[-1][1] == at:
            spans[-1] = (spans[-1][0], at + n)
        else:
            spans.append((at, at + n))
        at += n
    return spans


def merkle_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint string, nodes array<struct<level, start, length, digest>>):
    every document's root and inner nodes in text order (levels: 1 section, 2 paragraph,
    3 passage)."""
    schema = ("doc_id long, fingerprint string, "
              "nodes array<struct<level:int,start:long,length:long,digest:string>>")

    def nodes(tree):
        out = []

        def walk(node, level, at):
            for child in node[2]:
                out.append({"level": level, "start": at, "length": child[1],
                            "digest": child[0].hex()})
                walk(child, level + 1, at)
                at += child[1]
        walk(tree, 1, 0)
        return out

    def run(batches):
        for batch in batches:
            trees = [build(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t[0].hex() for t in trees]),
                 pa.array([nodes(t) for t in trees],
                          pa.list_(pa.struct([("level", pa.int32()), ("start", pa.int64()),
                                              ("length", pa.int64()), ("digest", pa.string())])))],
                ["doc_id", "fingerprint", "nodes"])
    return texts(docs).mapInArrow(run, schema).withColumn("doc_id", id_out())


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Documents dealt into id ranges, each with a copy of the row after its last one.

    Returns (part int, ahead boolean, doc_id long, text string), hash-partitioned by part
    and sorted by (part, doc_id, text) inside a partition; ``ahead`` marks the copy that
    only serves as the next document of its range's last row. Rows of one id are in one
    range; only ids and bounded lists of range bounds go through the driver.
    """
    spark = docs.sparkSession
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = ranges or 4 * n
    rows = texts(docs)
    ids = rows.select(F.col("doc_id").cast("double").alias("doc_id"))
    cuts = sorted(set(ids.stat.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)],
                                              0.25 / ranges)))
    # range i holds the ids from cut i-1 (inclusive) to cut i
    parts = rows.withColumn("id", F.col("doc_id").cast("double"))
    if cuts:
        splits = [-float("inf"), *cuts, float("inf")]
        parts = Bucketizer(splits=splits, inputCol="id", outputCol="part").transform(parts)
    else:
        parts = parts.withColumn("part", F.lit(0.0))
    parts = parts.select(F.col("part").cast("int").alias("part"), "doc_id", "text")
    heads = (parts.select("part", "doc_id").groupBy("part").agg(F.min("doc_id").alias("head"))
             .orderBy("part").collect())  # one row per range
    if not heads:
        return parts.select("part", F.lit(False).alias("ahead"), "doc_id", "text")
    before = {heads[i]["head"]: heads[i - 1]["part"] for i in range(len(heads))}
    # the head of each range is also sent to the range before it (the first to the last)
    back = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    dealt = parts.withColumn("to", F.explode(F.array_compact(F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("ahead")),
        F.when(F.col("doc_id").isin(list(before)),
               F.struct(back[F.col("doc_id")].alias("part"), F.lit(True).alias("ahead")))))))
    return (dealt.select("to.part", "to.ahead", "doc_id", "text")
            .repartition(n, "part").sortWithinPartitions("part", "ahead", "doc_id", "text"))


def edited(text: str, following: str) -> str:
    """The last floor(n/2) characters replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars long, edited binary, fingerprint, edited_fingerprint, near_edited,
    near_next): every document against its edited text and the next document by
    (doc_id, text); the last one's next is the first. Only the sort order within equal ids
    and the tie rule of copies decide between repeated ids."""
    schema = ("doc_id long, n_chars long, edited binary, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    names = [f.split()[0] for f in schema.split(", ")]

    def row(doc_id, text, tree, following, next_tree):
        changed = edited(text, following)
        changed_tree = tree if changed == text else build(changed)
        return (doc_id, len(text), changed.encode(), tree[0].hex(), changed_tree[0].hex(),
                likeness(tree, changed_tree), likeness(tree, next_tree))

    def run(batches):
        # rows of a range in order, then the row ahead: pair each with the one after it
        held, part = None, None
        for batch in batches:
            out = []
            for p, ahead, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if p != part:
                    held, part, closed = None, p, False
                if closed:
                    continue  # further rows with the id of the head: only the first is next
                tree = build(text)
                if held is not None:
                    out.append(row(*held, text, tree))
                held, closed = (doc_id, text, tree), ahead
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, (
                    pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string(),
                    pa.float64(), pa.float64()))], names)
    return with_next(docs).mapInArrow(run, schema).withColumn("doc_id", id_out())
