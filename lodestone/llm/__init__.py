"""Operators for preparing training data, each one a Spark job of its own.

Nothing outside this folder imports it.  Modules: ``near_dedup`` (1), ``ann`` (2), ``bpe`` (3),
``url_filter`` (4), ``quality_fm`` (5), ``jaccard`` (6), ``token_store`` (7), ``packing`` (8),
``toxicity`` (9), ``html_extract`` (10), ``fim`` (11), ``centroids`` (12), ``pieces`` (13); ``registry`` holds their queries and SQL.
"""
