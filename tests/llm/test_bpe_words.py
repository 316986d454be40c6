"""What a worker of BPE remembers of words."""

from auditloom.llm import bpe
from auditloom.llm.catalog import vocabulary


def test_a_common_word_is_merged_once(monkeypatch):
    """Rare words in any number don't drive out one that keeps coming; what is kept stays bounded."""
    monkeypatch.setattr(bpe, "REMEMBERED", 8)
    own = bpe.WordVocabulary(vocabulary("word_bpe_49k.json"))
    merged, merge = [], own.merge
    monkeypatch.setattr(own, "merge", lambda word: merged.append(word) or merge(word))
    encoder = bpe.Encoder(own)
    for k in range(40):
        rare = "zq" + chr(97 + k % 26) + chr(97 + k // 26)
        assert encoder.encode(f"common {rare}") == merge(b"common") + merge(rare.encode())
        assert len(encoder) + len(encoder.before) <= 9
    assert merged.count(b"common") == 1
