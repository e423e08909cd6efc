"""Column expressions (JVM-side, no UDFs) used by the operators."""

from .llr import independent, llr
from .rounding import round_half_away
from .sampling import keep_sampled, sample_hash
from .text import category_of_path, tokens

__all__ = ["llr", "independent", "round_half_away", "sample_hash", "keep_sampled", "tokens",
           "category_of_path"]
