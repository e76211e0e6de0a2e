"""ferry: move business records between systems of record on Spark, and prove nothing got lost.

Every operator is a ``DataFrame -> DataFrame`` function; planning and execution are left to
Catalyst and AQE. Sub-packages:

* ``functions``  Column-level helpers (match keys, text scrubbing, file names, stamps).
* ``sources``    Readers: quoted-dialect CSV, union by header, SQL text, binary files, headers.
* ``sinks``      Writers: CSV dialects, run-versioned snapshots, outcome routing.
* ``operators``  Relational building blocks (orphans, crosswalks, identity, owners, documents...).
* ``plans``      Composite jobs (transform, after-load, users) plus the registered queries.
* ``streaming``  Incremental crosswalk growth from landing outcome files.
"""

__version__ = "0.1.0"
