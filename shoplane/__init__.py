"""shoplane: a Spark-native analytics lane for a retail business.

``sources`` reads and writes tables, ``functions`` holds column expressions, ``operators`` the table operators,
``plans`` composes them into marts, questions and the gated build, ``streaming`` keeps the lane in step with the source.
"""
