"""Registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from functools import wraps

from .common import ship
from .decontaminate import OP1_SQL, op1_decontaminate
from .infill import OP12_SQL, op12_fill_in_middle
from .langid import op13_language
from .licenses import op3_licenses
from .mix import OP2_SQL, op2_mix
from .nbsvm import op10_nbsvm
from .repetition import OP9_SQL, op9_repetition
from .shards import op7_shards
from .simhash import op4_simhash
from .substring import OP8_SQL, op8_substring
from .surrogates import op6_surrogates
from .tokens import op5_token_shards
from .trie import OP11_SQL, op11_prefix_trie


def _registered(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


_OPERATORS = (
    op1_decontaminate,
    op2_mix,
    op3_licenses,
    op4_simhash,
    op5_token_shards,
    op6_surrogates,
    op7_shards,
    op8_substring,
    op9_repetition,
    op10_nbsvm,
    op11_prefix_trie,
    op12_fill_in_middle,
    op13_language,
)
QUERIES = {query.__name__: _registered(query) for query in _OPERATORS}
#: The other operators hash by CRC-32 or XXH64, tokenise, train or search a tree: SQL has no such functions.
ORACLE_SQL = {
    "op1_decontaminate": OP1_SQL,
    "op2_mix": OP2_SQL,
    "op8_substring": OP8_SQL,
    "op9_repetition": OP9_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
