"""Registration of queries and their check SQL."""

from ledgerloom.session import use_utc

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a (spark, sf_dir) -> DataFrame function, optionally with its check SQL."""

    def register(build):
        def run(spark, sf_dir):
            return build(use_utc(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
