"""segmint: user segmentation with k-means, built as Spark DataFrame jobs.

Layers:

* ``sources``   readers for the text/JSON inputs and the writers for results
* ``functions`` column expressions (vector maths, hashing, ids)
* ``operators`` feature building, training, assignment, profiling, scoring,
  k-curve analysis and k selection
* ``plans``     the end-to-end jobs (k-means job, k selection, monthly pipeline)
  and the query registry used by ``__spark_entry__``
* ``streaming`` applying a trained model to a stream of new rows
"""

__version__ = "0.1.0"
