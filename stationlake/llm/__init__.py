"""Training-data operators and their queries.

Each module holds one operator with a general interface (DataFrame in, DataFrame
out); ``registry`` wraps each as the thin query ``opN_<name>``.
"""
