"""Writers for the event stream, the lake layers and the warehouse."""
