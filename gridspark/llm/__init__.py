"""Operations of a training-data pipeline: deduplication, filters, classifiers, tokens, packing, search.

Nothing else in the library imports this package. Each module is one operator with its own general
interface and the thin query ``opN_<name>`` over the sample tables; ``queries`` lists them.
"""
