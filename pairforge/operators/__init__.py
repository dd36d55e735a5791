"""DataFrame -> DataFrame operators.

* ``pairs``       preference-pair selection and outcome accounting
* ``candidates``  long/wide candidate sets, prompt join, completeness and length filters
* ``ordering``    limits, prefix sums, dense ordinals, shards, seeded shuffle
* ``losses``      preference losses, implicit rewards, batch loss and metrics
* ``tokens``      token-table reductions, packing, truncation, role masks
* ``summaries``   score summaries, run records, shard counts
* ``hooks``       user generator / scorer hooks run per Arrow batch
"""
