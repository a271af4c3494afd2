"""Token ids of whole texts by a ``tokenizers`` vocabulary, one white-space segment at a time.

The vocabulary's pre-tokenizer drops white space and never joins characters
across it, and its normaliser composes no character with a space, so the ids
of a text are the ids of its white-space separated segments in order.
"""

from __future__ import annotations

import os

import numpy as np

from playmetrics.llm.segments import SegmentIds

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_STATE: dict[str, SegmentIds] = {}


def segment_ids(path: str) -> SegmentIds:
    """The worker's segment table of the vocabulary at ``path``."""
    if path not in _STATE:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def encode(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            found = [x.ids for x in tokenizer.encode_batch_fast(
                [s.decode("utf-8", "replace") for s in segments], add_special_tokens=False)]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((i for ids in found for i in ids), np.uint32, counts.sum()), counts

        _STATE[path] = SegmentIds(encode)
    return _STATE[path]
