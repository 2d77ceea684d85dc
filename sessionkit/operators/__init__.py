"""DataFrame -> DataFrame operators: session roll-ups, profiling, segmentation."""
