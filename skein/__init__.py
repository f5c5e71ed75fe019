"""skein: behaviour-log analytics and ranking as lazy Spark plans.

Sub-packages: ``sources`` (readers, writers, adapters), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame), ``plans`` (end-to-end
flows), ``streaming`` (incremental maintenance).
"""
