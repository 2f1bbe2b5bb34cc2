"""stratum: supervised tabular and text classification work as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (or a small fitted-state
DataFrame).  Learned state (medians, scales, class weights, term tables) is data.

Main entry points:

* ``stratum.session``: ``configure`` (UTC, shared checkpoint folder), ``build_session``, ``cut_lineage``
* ``stratum.functions.clean`` / ``dates`` / ``text``: Column expressions (labels, numbers, dates, tokens)
* ``stratum.operators.ordering``: ``select_ranks`` (exact k-th values without a global sort), ``rank_filter``
* ``stratum.operators.split``: ``scan_range``, ``page``, ``row_at``, ``split_range``, ``split_fraction``,
  ``split_shuffle``, ``split_stratified``, ``sample_negatives``
* ``stratum.operators.fitstate``: medians, modes, scaling, one-hot, class weights, profiles, drift
* ``stratum.operators.evaluate``: confusion counts, metrics, class report, exact ROC AUC, threshold sweep
* ``stratum.operators.text_models``: token counts, Naive Bayes, document frequency, top terms, TF-IDF, dedup
* ``stratum.operators.joins``: ``lookup_join`` (counted broadcast, hot-key salting beyond it)
* ``stratum.operators.models``: ``pyspark.ml`` estimators, ``score``, ``score_linear``, ``rank_features``
* ``stratum.plans``: end-to-end flows per domain and ``catalog.QUERIES`` (one query per inventory id)
* ``stratum.streaming.score``: file-stream scoring and running evaluation
"""

__version__ = "0.1.0"
