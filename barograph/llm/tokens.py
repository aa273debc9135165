"""Token ids of whole texts by the tokenizers library, each distinct chunk encoded once."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from barograph.llm.chunks import CHUNKS_KEPT, ChunkMemory

#: So many new chunks go to the tokenizer as one text; it is slower on longer ones.
RUN = 64


@lru_cache(maxsize=1)
def token_memory(path: str, kept: int = CHUNKS_KEPT, plain: bool = False) -> ChunkMemory:
    """Ids as little-endian unsigned 32-bit integers; one memory per worker process.

    A worker keeps it between tasks, and a chunk takes some 200 bytes: ``kept`` is
    the place to save memory where workers do other work too.
    ``plain`` takes special tokens' strings in texts for ordinary text.
    ``path`` names a byte-level BPE file whose words take one blank before them.
    Chunks that begin with a blank and end in no white space stand side by side
    in one text as they do in a document, so many go to the tokenizer at once;
    their ids are told apart by the bytes they stand for.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = plain
    added = {n: x.content for n, x in tokenizer.get_added_tokens_decoder().items()}
    width = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, n in tokenizer.get_vocab().items():
        # A letter of a byte-level token stands for a byte.
        width[n] = len(added[n].encode()) if n in added else len(token)

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def encode(chunks: list[str]) -> list[bytes]:
        beside = [c[0:1] == " " and len(c) > 1 and not c[-1].isspace() for c in chunks]
        together = list(compress(chunks, beside))
        alone = [c for c, b in zip(chunks, beside, strict=True) if not b]
        runs = ["".join(together[k : k + RUN]) for k in range(0, len(together), RUN)]
        coded: list[bytes] = []
        if runs:
            ids = np.concatenate(ids_of(runs))
            bodies = pa.array(together, pa.large_string())
            ends = np.cumsum(pc.binary_length(bodies).to_numpy())
            cuts = ((np.searchsorted(np.cumsum(width[ids]), ends) + 1) * 4).tolist()
            raw = ids.tobytes()
            coded = [raw[x:y] for x, y in zip([0, *cuts], cuts)]
        rest = iter(ids_of(alone))
        found = iter(coded)
        return [next(found) if b else next(rest).tobytes() for b in beside]

    return ChunkMemory(encode, kept)
