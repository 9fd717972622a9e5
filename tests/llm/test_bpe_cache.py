import gc

from strataflow.llm import bpe


def test_cached_pieces_cost_the_garbage_collector_nothing():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257}
    coder = bpe.TextEncoder(bpe.PrefixEncoder(ranks), r"\w+|\W+")
    assert coder.encode("abcab ba abc") == [257, 256, 32, 98, 97, 32, 257]
    gc.collect()
    assert coder._cache and not any(map(gc.is_tracked, coder._cache.values()))
    assert not any(map(gc.is_tracked, coder.encoder._pairs))
