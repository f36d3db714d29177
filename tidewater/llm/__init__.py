"""Training-data operators: deduplication, mixing, tokens, packing, toxicity.

Nothing outside this subpackage imports it. Each operator has its own module;
``queries.py`` registers one query per operator and the corpus pipeline.

Rules that hold for every operator here:

* A null text counts as the empty text, and whole texts are processed.
* Operators read only the id and text (or vector) columns they are given.
  Other columns pass through untouched or are left out, whatever their names;
  internal columns get names that the input does not use.
* An empty table gives an empty result with the documented columns.
* Tables that are read more than once are written to the shared folder named
  by ``spark.checkpoint.dir``, so a lost executor costs only task retries.
"""
