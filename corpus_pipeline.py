"""The corpus pipeline: stages over the documents table, each one calling an operator.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last
return the columns of documents; the last one returns a row for each document of the mix, repeated
as often as the mix takes it. Fewer rows than before mean a decision: the quality classifier
rejects, near copies go, the mix leaves out or repeats documents. Empty tables pass through.
"""

import public_tokenizers

from fragloom.llm.encoding import encoded_digests
from fragloom.llm.mixing import mixed_documents
from fragloom.llm.ngram_join import remove_near_copies
from fragloom.llm.quality import without_bad
from fragloom.llm.shelf import Shelf
from fragloom.llm.suffix_dedup import without_repeats

VOCABULARY = "byte_bpe_50k.json"


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return without_bad(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark, docs, sf_dir):
    """One document of each group of near copies stays: five words, similarity 0.8."""
    return remove_near_copies(docs, 5, (80, 100))


def repeats(spark, docs, sf_dir):
    """Passages of 100 bytes that start earlier in the corpus are cut out of the texts."""
    return without_repeats(docs, 100)


def mixture(spark, docs, sf_dir):
    """Documents are left out or repeated so that each source has its target number of words."""
    return mixed_documents(docs)


def tokens(spark, docs, sf_dir):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document of the mix."""
    return encoded_digests(docs, public_tokenizers.path(VOCABULARY), apart=True)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeats),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

#: Trained classifiers, a hash-seeded mix and BPE have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to the documents; each result is written and read again."""
    shelf = Shelf(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = shelf.keep(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
