"""Sources, sinks and codecs: JSON documents and replies, the versioned document store."""
