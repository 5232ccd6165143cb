from tonguemill.functions.literals import (
    conversation_value_chars,
    conversation_values,
    py_str,
    rebuild_conversation,
)
from tonguemill.functions.text import (
    byte_length,
    char_length,
    fixed_slices,
    sentences,
    split_literal,
    strip_text,
    text_digest,
    word_count,
    words,
)
from tonguemill.functions.tokens import Vocabulary, bpe, chars4, tokenizer, words075

__all__ = [
    "Vocabulary", "bpe", "byte_length", "char_length", "chars4", "conversation_value_chars", "conversation_values",
    "fixed_slices", "py_str", "rebuild_conversation", "sentences", "split_literal", "strip_text",
    "text_digest", "tokenizer", "word_count", "words", "words075",
]
