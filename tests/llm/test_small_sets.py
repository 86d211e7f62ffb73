"""Near duplicates of very few shingles, whose bands alone miss some."""

import numpy as np
import pyarrow as pa

from loamsift.llm import minhash, wordhash


def bands_of(texts):
    words, at = wordhash.text_words(pa.array(texts), lower=True)
    sets = minhash._sets(words, at)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return [set(keys.tolist()) for keys in minhash._bands(minhash._registers(np.concatenate(sets), owner, len(sets)))]


def test_one_word_more_than_seven(spark):
    short = [" ".join(f"word{i}x{j}" for j in range(7)) for i in range(40_000)]
    longer = [f"{text} more" for text in short]
    missed = [i for i, (a, b) in enumerate(zip(bands_of(short), bands_of(longer))) if not a & b]
    assert missed  # three shingles of four in common, and no band
    rows = [(10 * i + k, text) for i in missed[:5] for k, text in ((1, short[i]), (2, longer[i]), (3, longer[i].replace("x0", "y0")))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {k: k - k % 10 + 1 if k % 10 < 3 else k for k, _ in rows}
