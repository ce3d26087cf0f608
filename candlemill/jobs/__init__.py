"""Command line jobs: ``spark-submit`` a module of this package with ``--help`` for its options.

Master, packages and storage credentials come from spark-submit and the cluster's configuration.
"""
