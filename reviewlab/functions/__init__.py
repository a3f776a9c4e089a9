"""Column expressions (JVM-side, inside whole-stage codegen)."""

from reviewlab.functions.text import (  # noqa: F401
    clean_review, clean_text, condition_pattern, is_marker, lower, replace_residue,
    collapse_whitespace, strip_punctuation, tokens, upper_word_count, word_count,
)
from reviewlab.functions.encode import (  # noqa: F401
    bool_to_int, rating_band3, rating_binary, threshold, dummies_drop_first,
)
